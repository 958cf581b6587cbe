"""Language identification by cross-parsing entropy.

A language is known by the suffix automaton of a sample of its text: it tells how long a string can be
matched anywhere in the sample. A text is parsed greedily into phrases, each the longest match from where the last
one ended; in its own language it needs few long phrases. Phrases are normalised to an entropy,
phrases * log2(length of the sample) / length of the text, and the least one wins.

The samples are bounded by parameters, so the automata are, and they are broadcast. Every letter of a sample is told
apart. Texts are parsed whole, many at a time: a step of the parse is one look-up for a character of each of
thousands of texts, and the state of a text is carried on until it ends.
"""

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagedoor.session import settle

UNKNOWN = "und"
FOLDS = 5
# Bounds of what is learned: documents a language, and characters of all languages together. Texts of up to
# USUAL_CHARS are learned before longer ones.
SAMPLE_DOCS = 256
ALL_CHARS = 1 << 18
USUAL_CHARS = 4_000
# Letters with a column of the automaton's table; the ways on by rarer ones are found by search.
DENSE = 60
# Texts and characters parsed together, at most, and characters of each laid out at once.
PART_DOCS, PART_CHARS = 5_000, 1 << 24
PIECE = 2_048
COLUMNS = 4_096
SPACE = 32


@functools.cache
def _letters() -> np.ndarray:
    """For every code point, itself if it is a letter, else a space."""
    return np.array([i if chr(i).isalpha() else SPACE for i in range(0x110000)], np.uint32)


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text, every run of other characters being one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    points = _letters()[points]
    space = points == SPACE
    return points[~(space & np.concatenate(([True], space[:-1])))] if len(points) else points


class Parser:
    """A language's greedy parser: the next state for each state and letter.

    Frequent letters have a table; an entry below zero ends a phrase, and its complement is the state in which
    the next phrase begins. Rare letters have a sorted list of (state, letter). State 0 is that before a text.
    """

    def __init__(self, sample: np.ndarray):
        known, counts = np.unique(sample, return_counts=True)
        frequent = np.argsort(-counts, kind="stable")
        self.dense = np.sort(known[frequent[:DENSE]])
        self.rare = np.sort(known[frequent[DENSE:]])
        self.size = len(sample)
        # Codes: the dense letters, then one for all that the sample lacks, then the rare letters.
        self.width = len(self.dense) + 1
        codes = self.classes()[sample]
        states = _suffix_automaton(codes.tolist())
        lacking = len(states)
        table = np.full((len(states) + 1, self.width), -1, np.int32)
        keys, after = [], []
        for s, edges in enumerate(states):
            for code, target in edges.items():
                if code < self.width:
                    table[s, code] = target
                else:
                    keys.append(s * len(self.rare) + code - self.width)
                    after.append(target)
        # A character that the sample lacks is a phrase; the last state has no way on.
        begin = np.where(table[0] < 0, lacking, table[0])
        table = np.where(table < 0, ~begin[None, :], table)
        # Before a text, nothing has begun that could end.
        table[0] = begin
        self.table = table.astype(np.int32).ravel()
        order = np.argsort(keys) if keys else []
        self.keys = np.array(keys, np.int64)[order] if keys else np.empty(0, np.int64)
        self.after = np.array(after, np.int64)[order] if keys else np.empty(0, np.int64)
        self.rare_begin = np.array([states[0][self.width + i] for i in range(len(self.rare))], np.int64)

    def classes(self) -> np.ndarray:
        """The code of every code point."""
        most = self.width + len(self.rare)
        out = np.full(0x110000, self.width - 1, np.uint8 if most < 256 else np.uint32)
        out[self.dense] = np.arange(len(self.dense))
        out[self.rare] = self.width + np.arange(len(self.rare))
        return out

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next states, complemented where a phrase ended."""
        if not len(self.rare):
            return self.table[state * self.width + code]
        after = self.table[state * self.width + np.minimum(code, self.width - 1)]
        where = np.flatnonzero(code >= self.width)
        if len(where):
            letter = code[where].astype(np.int64) - self.width
            key = state[where] * len(self.rare) + letter
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            # Every letter of the sample leads on from the first state, so nothing ends there.
            after[where] = np.where(self.keys[at] == key, self.after[at], ~self.rare_begin[letter])
        return after


def _suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    edges, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return edges


def phrases(parser: Parser, pieces: np.ndarray, lengths: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Phrases that end in each piece; ``state`` holds the states before and, afterwards, after the pieces.

    ``pieces`` has a row a position and a column a piece, long pieces first.
    """
    ended = np.zeros(pieces.shape[1], np.int64)
    active = np.searchsorted(-lengths, -np.arange(len(pieces)), side="left")
    for t, k in enumerate(active):
        after = parser.step(state[:k], pieces[t, :k])
        end = after >> 31
        ended[:k] -= end
        state[:k] = after ^ end
    return ended


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learn(docs: DataFrame, doc_id: str, text: str, lang: str) -> dict[str, Parser]:
    """A parser for each language of the rows that aren't held out.

    Per language, ``SAMPLE_DOCS`` documents are looked at, those of up to ``USUAL_CHARS`` first, by the least hash of
    their id. Whole texts are learned as long as all languages together stay within ``ALL_CHARS``; only if the
    first text alone is longer than its language's share is it cut there.
    """
    usable = F.col(doc_id).isNotNull() & F.col(lang).isNotNull() & ~_held_out(F.col(doc_id)) & F.col(text).isNotNull()
    order = Window.partitionBy("lang").orderBy("long", F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
    # Which documents: without their texts, cut to so many a language before the shuffle.
    long = F.length(text) > USUAL_CHARS
    some = docs.filter(usable).select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), long.alias("long"))
    chosen = some.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= SAMPLE_DOCS)
    chosen = settle(chosen.groupBy("doc_id", "lang").agg(F.min("n").alias("n")), "sample-ids")
    languages = chosen.select("lang").distinct().count()
    share = ALL_CHARS // max(languages, 1)
    named = chosen.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), "n")
    # SAMPLE_DOCS rows a language; Spark broadcasts them if it measures them as small.
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = texts.join(named, (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang"))).select(
        "lang", "n", "text"
    )

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("n").sort_values("n")
        parts = [letters_of(t) for t in rows["text"]]
        whole = np.searchsorted(np.cumsum([len(p) for p in parts]), share, "right")
        sample = np.concatenate(parts[: max(whole, 1)])[:share]
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "sample": [sample.astype("<u4").tobytes()]})

    samples = rows.groupBy("lang").applyInPandas(build, "lang string, sample binary").collect()
    found = {r["lang"]: np.frombuffer(bytes(r["sample"]), "<u4") for r in samples}
    return {k: Parser(found[k]) for k in sorted(found) if (found[k] != SPACE).any()}


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of a bounded number of texts and characters, with their texts."""
    texts = batch.column(column).to_pylist()
    at = 0
    while at < len(texts):
        upto, size = at + 1, len(texts[at] or "")
        while upto < len(texts) and upto - at < PART_DOCS and size + len(texts[upto] or "") <= PART_CHARS:
            size += len(texts[upto] or "")
            upto += 1
        yield batch.slice(at, upto - at), texts[at:upto]
        at = upto


def entropies(parsers: dict[str, Parser], texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Normalised phrases, a row a text and a column a language, and whether a text has a letter.

    Texts are laid out side by side, ``PIECE`` characters of each at a time, long ones first.
    """
    points = [letters_of(text) if text else np.empty(0, np.uint32) for text in texts]
    sizes = np.array([len(p) for p in points], np.int64)
    has_letter = np.array([bool((p != SPACE).any()) for p in points], bool)
    order = np.argsort(-sizes, kind="stable")
    lengths = sizes[order]
    counts = np.ones((len(texts), len(parsers)))
    states = np.zeros((len(parsers), len(texts)), np.int64)
    classes = [p.classes() for p in parsers.values()]
    for at in range(0, int(lengths[0]) if len(lengths) else 0, PIECE):
        active = int(np.searchsorted(-lengths, -at, side="left"))
        for first in range(0, active, COLUMNS):
            some = order[first : min(active, first + COLUMNS)]
            left = np.minimum(sizes[some] - at, PIECE)
            matrix = np.full((left[0], len(some)), SPACE, np.uint32)
            for column, i in enumerate(some):
                matrix[: left[column], column] = points[i][at : at + PIECE]
            for j, parser in enumerate(parsers.values()):
                counts[some, j] += phrases(parser, classes[j][matrix], left, states[j, first : first + len(some)])
    bits = np.log2([max(p.size, 2) for p in parsers.values()])
    return counts * bits / np.maximum(sizes, 1)[:, None], has_letter


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of ``docs``.

    Learned from rows whose crc32 of the id, as text, is not 0 modulo 5; predictions see the text only.
    ``score`` compares the two best languages' entropies a <= b, as 1 - a / b, so ties score 0 and go
    to the language that comes first; with a single language it is 1.

    - A null text, or one without a letter, is ``und`` with score 0; so is every text if nothing can be learned.
    - A null doc_id isn't held out and isn't learned from. Repeated rows get equal predictions.
    - Very long texts are parsed whole, from their first character to their last.
    - An empty table gives an empty result; columns other than those named are not read.
    """
    parsers = docs.sparkSession.sparkContext.broadcast(learn(docs, doc_id, text, lang))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = parsers.value
        names = np.array([*known, UNKNOWN], object)
        for batch in batches:
            for part, texts in _parts(batch, 2):
                best, score = np.full(len(texts), len(known)), np.zeros(len(texts))
                if known:
                    bits, has_letter = entropies(known, texts)
                    best = np.where(has_letter, bits.argmin(axis=1), len(known))
                    two = np.sort(bits, axis=1)[:, :2]
                    margin = 1 - two[:, 0] / np.maximum(two[:, 1], 1e-12) if len(known) > 1 else np.ones(len(texts))
                    score = np.where(has_letter, np.clip(margin, 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), _held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text")
    )
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")
