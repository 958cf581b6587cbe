"""Two tokenizers' tokens of the same text, linked where they cover the same bytes.

A document's tokens are cumulative byte ends on either side. Ends that both sides have, found by searching
one sorted list for the other, cut the document into groups; within a group every token of one side is
linked to every one of the other. How often a pair of ids is linked is counted over documents, and each
document's links are then weighed by these counts: the most frequent pairs, of a bounded number, where the
documents are, all others by a join.
"""

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagedoor.session import settle

# Pairs of ids that are broadcast, at most.
HOT_PAIRS = 1 << 17
# Documents that are tokenised together, and characters of them at most.
BATCH_DOCS, BATCH_CHARS = 256, 1 << 20
# Strings that are laid out at once; bounds memory for very long texts.
LAID_OUT = 1 << 18
# How words are cut before byte pairs are merged, and the mark that stands for a space.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_MARK = "▁"
# Characters whose class every version of Unicode agrees on.
_SETTLED = re.compile("[^\x00-ɏ‐-‧]")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, and the byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Strings:
    """Numbered byte strings, end to end in one array."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array(list(map(len, strings)), np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray) -> bytes:
        """The strings of these numbers, one after the other."""
        return b"".join(self._laid_out(numbers[at : at + LAID_OUT]) for at in range(0, len(numbers), LAID_OUT))

    def _laid_out(self, numbers: np.ndarray) -> bytes:
        lengths = self.lengths[numbers]
        before = np.cumsum(lengths) - lengths
        places = np.repeat(self.starts[numbers] - before, lengths)
        places += np.arange(len(places))
        return self.bytes[places].tobytes()


@dataclass(frozen=True)
class Side:
    """Ids of texts, and the bytes of each id."""

    encode: Callable[[list[str]], list[np.ndarray]]
    pieces: list[bytes]


def byte_level(path: str) -> Side:
    """A byte-level vocabulary with merges in a JSON file; a space is put before every text.

    Texts of European letters, whose classes no version of Unicode disputes, go through a faster encoder of the same
    vocabulary, others through the file's own.
    """
    import tiktoken
    import tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    exact = tokenizers.Tokenizer.from_file(path)
    exact.encode_special_tokens = True
    with open(path, encoding="utf-8") as lines:
        described = json.load(lines)
    alphabet = byte_alphabet()
    special = {t["content"] for t in described["added_tokens"]}
    entries = sorted(described["model"]["vocab"].items(), key=lambda x: x[1])
    pieces = [b""] * (entries[-1][1] + 1)
    for entry, i in entries:
        pieces[i] = entry.encode() if entry in special else bytes(alphabet[c] for c in entry)
    ranks = {pieces[i]: i for entry, i in entries if entry not in special}
    fast = tiktoken.Encoding("aligned", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        rest = []
        for i, text in enumerate(texts):
            if _SETTLED.search(text):
                rest.append(i)
            else:
                out[i] = fast.encode_to_numpy(" " + text, disallowed_special=())
        for i, found in zip(rest, exact.encode_batch_fast([" " + texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(found.ids, np.uint32)
        return out

    return Side(encode, pieces)


def piece_level(path: str) -> Side:
    """A sentencepiece model, which puts a space before every text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
        for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
    ]

    def encode(texts: list[str]) -> list[np.ndarray]:
        return [np.fromiter(ids, np.uint32, len(ids)) for ids in model.encode(texts, num_threads=1)]

    return Side(encode, pieces)


def public_vocabularies(folder: str | None = None) -> tuple[str, str]:
    """Files of the two vocabularies, below ``folder`` or where the installed package keeps them."""
    names = ("byte_bpe_50k.json", "piece_bpe_32k.model")
    if folder is not None:
        return tuple(os.path.join(folder, n) for n in names)
    import public_tokenizers

    return tuple(str(public_tokenizers.path(n)) for n in names)


@dataclass
class Aligned:
    """One document's ids, and the index of each group's first token on both sides, and where the last ends."""

    left: np.ndarray
    right: np.ndarray
    left_cuts: np.ndarray
    right_cuts: np.ndarray

    def groups(self) -> int:
        return len(self.left_cuts) - 1

    def written(self, names: "Names") -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids of every group in order.

        Each id is written with the mark that follows it, at its place in the whole list: after the right
        tokens of the groups before its own, and those of a right token's own group on the left.
        """
        n, m = np.diff(self.left_cuts), np.diff(self.right_cuts)
        out = np.empty(len(self.left) + len(self.right), np.int64)
        out[np.arange(len(self.left)) + np.repeat(self.right_cuts[:-1], n)] = names.left(self.left, self.left_cuts[1:] - 1)
        out[np.arange(len(self.right)) + np.repeat(self.left_cuts[1:], m)] = names.right(self.right, self.right_cuts[1:] - 1)
        return names.strings.joined(out)[:-1]

    def links(self, width: int) -> np.ndarray:
        """``left id * width + right id`` of every link, slice by slice."""
        n, m = np.diff(self.left_cuts), np.diff(self.right_cuts)
        # Every left token meets the ``m`` right tokens of its group, from the group's first one on.
        times = np.repeat(m, n)
        left = np.repeat(self.left.astype(np.int64), times)
        first = np.repeat(self.right_cuts[:-1], n * m)
        step = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        return left * width + self.right[first + step]


class Names:
    """Ids in decimal, followed by a comma, or by the mark that ends a group on their side."""

    def __init__(self, left: int, right: int):
        self.count = max(left, right)
        self.strings = Strings([f"{i}{mark}".encode() for mark in ",|;" for i in range(self.count)])

    def left(self, ids: np.ndarray, lasts: np.ndarray) -> np.ndarray:
        return self._marked(ids, lasts, self.count)

    def right(self, ids: np.ndarray, lasts: np.ndarray) -> np.ndarray:
        return self._marked(ids, lasts, 2 * self.count)

    def _marked(self, ids: np.ndarray, lasts: np.ndarray, mark: int) -> np.ndarray:
        out = ids.astype(np.int64)
        out[lasts] += mark
        return out


def align(left: np.ndarray, right: np.ndarray, left_lengths: np.ndarray, right_lengths: np.ndarray) -> Aligned:
    """Groups between the byte ends that both sides have; what has no bytes belongs to the group before it."""
    ends, others = np.cumsum(left_lengths[left]), np.cumsum(right_lengths[right])
    upto = np.searchsorted(others, ends, "right")
    common = others[upto - 1] == ends
    common &= upto > 0
    common[:-1] &= ends[1:] != ends[:-1]
    return Aligned(left, right, np.append(0, np.flatnonzero(common) + 1), np.append(0, upto[common]))


_ALIGNED = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())),
])
_ALIGNED_DDL = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<bigint>, times array<int>"
)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str | None]]]:
    """(ids, texts) of a bounded number of documents and characters; a longer text is a chunk of its own."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py()
            length = len(text or "")
            if ids and (len(ids) == BATCH_DOCS or size + length > BATCH_CHARS):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i.as_py())
            texts.append(text)
            size += length
    if ids:
        yield ids, texts


def aligned(
    docs: DataFrame, vocabularies: tuple[str, str], doc_id: str = "doc_id", text: str = "text", *, digest: bool = False
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times), one row per row of ``docs``.

    ``groups`` lists the ids of every group as ``a1,a2|b1;a3|b2,b3``, or its SHA-256 if ``digest`` is set; ``pairs`` are
    the distinct linked pairs, as A id times the number of B ids plus B id, ``times`` how often each is linked.

    - Null and empty texts, and those whose tokens' bytes on either side aren't those of the text after a space, have
      no tokens: zeros, an empty string, empty arrays. Null and repeated ids are rows like any others.
    - Texts of any length are tokenised whole. An empty table gives an empty result; other columns are not read.
    """
    left_path, right_path = vocabularies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        left, right = byte_level(left_path), piece_level(right_path)
        left_bytes, right_bytes = Strings(left.pieces), Strings(right.pieces)
        names = Names(len(left.pieces), len(right.pieces))
        width = len(right.pieces)
        for ids, texts in _chunks(batches):
            filled = [t for t in texts if t]
            both = zip(left.encode(filled), right.encode(filled), strict=True)
            rows: dict[str, list] = {name: [] for name in _ALIGNED.names}
            for i, t in zip(ids, texts, strict=True):
                a, b = next(both) if t else ((), ())
                whole = b" " + t.encode() if t else b""
                if not t or left_bytes.joined(a) != whole or right_bytes.joined(b) != whole:
                    row = (i, 0, 0, 0, 0, "", [], [])
                else:
                    found = align(a, b, left_bytes.lengths, right_bytes.lengths)
                    links = found.links(width)
                    pairs, times = np.unique(links, return_counts=True)
                    groups = found.written(names)
                    groups = hashlib.sha256(groups).hexdigest() if digest else groups.decode()
                    row = (i, len(a), len(b), found.groups(), len(links), groups, pairs, times)
                for name, value in zip(_ALIGNED.names, row, strict=True):
                    rows[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in _ALIGNED], schema=_ALIGNED)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _ALIGNED_DDL)


def pair_counts(found: DataFrame, width: int) -> DataFrame:
    """(pair, a, n, best): how many documents hold a pair linked, and whether no pair of its A id is in more.

    The greatest counts of A ids are a row for each id of the vocabulary, and broadcast.
    """
    counts = settle(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    of = F.floor(F.col("pair") / width).cast("int")
    most = counts.groupBy(of.alias("a")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("a", of).join(F.broadcast(most), "a")
    return joined.select("pair", "a", "n", (F.col("n") == F.col("most")).alias("best"))


def _hottest(counts: DataFrame, at_most: int) -> DataFrame:
    """Pairs with the greatest counts: all above a power of two that leaves ``at_most`` of them."""
    size = F.floor(F.log2("n")).cast("int")
    bins = counts.groupBy(size.alias("size")).count().collect()  # 64 rows at most
    least, taken = 64, 0
    for b in sorted(bins, key=lambda b: -b["size"]):
        taken += b["count"]
        if taken > at_most:
            break
        least = b["size"]
    return counts.filter(size >= least)


def weighed(found: DataFrame, width: int, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) of settled rows ``found`` that have a column ``row`` and links.

    Pairs of the most documents meet their counts by a broadcast of at most ``hot_pairs`` rows. The others,
    none of which is in many documents, are shuffled. Sums per row begin before the shuffle.
    """
    counts = settle(pair_counts(found, width), "pairs")
    hot = settle(_hottest(counts, hot_pairs).select("pair", "n", "best"), "hot-pairs")
    cold = counts.join(hot.select("pair"), "pair", "left_anti").select("pair", "n", "best")
    each = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    each = each.select("row", F.col("l.pairs").alias("pair"), F.col("l.times").cast("bigint").alias("times"))
    met = each.join(F.broadcast(hot), "pair", "left")
    seen = met.filter("n is not null").select("row", "times", "n", "best")
    rest = met.filter("n is null").select("row", "pair", "times").join(cold, "pair").select("row", "times", "n", "best")
    return seen.union(rest).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )


def alignment(
    docs: DataFrame, vocabularies: tuple[str, str], doc_id: str = "doc_id", text: str = "text", *, hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``.

    ``n_best`` counts the links whose pair is in as many documents as any pair of its A id, ``count_sum`` adds up
    the number of documents of each link's pair. Edge cases are those of :func:`aligned`; rows that
    repeat are documents of their own in the counts. Documents without links have zeros.
    """
    found = aligned(docs, vocabularies, doc_id, text, digest=True)
    # Numbered as it is written, so every later read sees the same rows.
    found = settle(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    sums = weighed(found, len(piece_level(vocabularies[1]).pieces), hot_pairs)
    zero = F.lit(0).cast("bigint")
    return found.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), F.col("groups").alias("groups_sha256"),
    )
