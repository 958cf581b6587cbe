"""Token ids packed into matrices.

Tasks tokenise their documents, cut those that are longer than a row into pieces, and pack the pieces of a
block into as few rows as best fit decreasing finds: the longest piece first, each into the row that it fills
best. A segment tree over free capacities finds that row. Nothing is shuffled, and nothing is lost: the pieces of
a document, in order, are its ids and an end mark.
"""

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_TOKENS = 2_048
# Tokens that are packed together, and rows of a matrix at most.
BLOCK_TOKENS = 1 << 21
MATRIX_ROWS = 64


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level vocabulary in a file of base64 tokens and ranks, how texts are cut, and the end mark."""

    path: str
    pattern: str
    end: int

    def ranks(self) -> dict[bytes, int]:
        with open(self.path, "rb") as lines:
            return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken", end: int = 50256) -> Vocabulary:
    import public_tokenizers

    return Vocabulary(str(public_tokenizers.path(name)), public_tokenizers.PATTERN, end)


@dataclass
class BestFit:
    """Rows with free capacity, by capacity: a segment tree says which capacities occur."""

    capacity: int
    leaves: int = 1
    rows: list[list[int]] = field(default_factory=list)
    tree: list[bool] = field(default_factory=list)
    used: int = 0

    def __post_init__(self):
        while self.leaves <= self.capacity:
            self.leaves *= 2
        self.rows = [[] for _ in range(self.capacity + 1)]
        self.tree = [False] * (2 * self.leaves)

    def _mark(self, free: int) -> None:
        node, some = self.leaves + free, bool(self.rows[free])
        while node and self.tree[node] != some:
            self.tree[node] = some
            node //= 2
            some = node and (self.tree[2 * node] or self.tree[2 * node + 1])

    def _least(self, size: int) -> int:
        """The least capacity of ``size`` or more that a row has free, or -1."""
        node = self.leaves + size
        if self.tree[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return -1

    def place(self, size: int) -> tuple[int, int]:
        """The row and the offset for a piece of ``size``."""
        free = self._least(size)
        if free < 0:
            row, free = self.used, self.capacity
            self.used += 1
        else:
            row = self.rows[free].pop()
            self._mark(free)
        left = free - size
        if left:
            self.rows[left].append(row)
            self._mark(left)
        return row, self.capacity - free


def pack(sizes: list[int], capacity: int) -> tuple[list[tuple[int, int]], int]:
    """(row, offset) of each piece by best fit decreasing, and the number of rows."""
    bins = BestFit(capacity)
    places = [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        places[i] = bins.place(sizes[i])
    return places, bins.used


@dataclass
class _Piece:
    doc_id: int | None
    number: int
    pieces: int
    ids: np.ndarray


_PACKED = pa.schema([
    ("matrix", pa.string()), ("n_rows", pa.int32()), ("row_tokens", pa.int32()), ("id_bytes", pa.int32()),
    ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())),
    ("doc_ids", pa.list_(pa.int64())), ("piece", pa.list_(pa.int32())), ("pieces", pa.list_(pa.int32())),
])
_PACKED_DDL = (
    "matrix string, n_rows int, row_tokens int, id_bytes int, ids binary, cu_seqlens array<int>, "
    "position_resets array<int>, doc_ids array<bigint>, piece array<int>, pieces array<int>"
)


def _matrices(block: list[_Piece], name: str, capacity: int, end: int, kind: str) -> pa.RecordBatch:
    """The packed rows of a block, some matrices of ``MATRIX_ROWS``.

    ``cu_seqlens`` runs over a matrix read row by row, what is left free in a row being a segment of its own,
    filled with the end mark; a free segment has doc_id null and piece -1. Positions begin anew at
    each of ``position_resets``.
    """
    places, n_rows = pack([len(p.ids) for p in block], capacity)
    order = sorted(range(len(block)), key=places.__getitem__)
    out: list[dict] = []
    at = 0
    for first in range(0, n_rows, MATRIX_ROWS):
        rows = min(MATRIX_ROWS, n_rows - first)
        ids = np.full(rows * capacity, end, kind)
        starts, owners = [], []
        for row in range(first, first + rows):
            base, filled = (row - first) * capacity, 0
            while at < len(order) and places[order[at]][0] == row:
                piece = block[order[at]]
                ids[base + filled : base + filled + len(piece.ids)] = piece.ids
                starts.append(base + filled)
                owners.append((piece.doc_id, piece.number, piece.pieces))
                filled += len(piece.ids)
                at += 1
            if filled < capacity:
                starts.append(base + filled)
                owners.append((None, -1, 0))
        out.append({
            "matrix": f"{name}-{len(out)}", "n_rows": rows, "row_tokens": capacity, "id_bytes": ids.itemsize,
            "ids": ids.tobytes(), "cu_seqlens": [*starts, rows * capacity], "position_resets": starts,
            "doc_ids": [o[0] for o in owners], "piece": [o[1] for o in owners], "pieces": [o[2] for o in owners],
        })
    return pa.RecordBatch.from_pylist(out, schema=_PACKED)


def packed(
    docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text", *, row_tokens: int = ROW_TOKENS
) -> DataFrame:
    """Matrices of ``docs``: id matrices, cumulative segment lengths, position resets, and whose segments they are.

    Ids are little-endian, of two bytes where the vocabulary allows it, else four. A document is its
    ids and the end mark; if that is longer than a row, it is cut into full rows and a rest.

    - Null and empty texts are the end mark alone. A null doc_id is kept as null, with a piece number of 0 or more.
    - Repeated rows are packed as often as they occur. Strings that look like special tokens are ordinary text.
    - Texts of any length are tokenised whole, so decoding gives them back byte by byte.
    - An empty table gives no matrices; columns other than the two named are not read.
    """
    if row_tokens < 1:
        raise ValueError("a row holds a token or more")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.ranks())
    pattern, end = vocabulary.pattern, vocabulary.end
    kind = "<u2" if max(end, max(shared.value.values())) < 1 << 16 else "<u4"

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        from pyspark import TaskContext

        encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        task = TaskContext.get().partitionId()
        block, size, number = [], 0, 0
        for batch in batches:
            for owner, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.array([*encoding.encode_ordinary(text.as_py() or ""), end], kind)
                owner, pieces = owner.as_py(), -(-len(ids) // row_tokens)
                block += [_Piece(owner, i, pieces, ids[i * row_tokens : (i + 1) * row_tokens]) for i in range(pieces)]
                size += len(ids)
                if size >= BLOCK_TOKENS:
                    yield _matrices(block, f"{task}-{number}", row_tokens, end, kind)
                    block, size, number = [], 0, number + 1
        if block:
            yield _matrices(block, f"{task}-{number}", row_tokens, end, kind)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(tokenise, _PACKED_DDL)


def write_packed(docs: DataFrame, vocabulary: Vocabulary, path: str, **options) -> None:
    packed(docs, vocabulary, **options).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, piece, pieces, matrix, matrix_row, matrix_column, n_tokens, ids_sha256) of written matrices.

    One row per segment with a document; the digest is that of the segment's ids as they stand in the matrix.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("pieces", pa.int32()), ("matrix", pa.string()),
        ("matrix_row", pa.int32()), ("matrix_column", pa.int32()), ("n_tokens", pa.int32()), ("ids_sha256", pa.string()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                m = {name: batch.column(i)[at].as_py() for i, name in enumerate(_PACKED.names)}
                width, row = m["id_bytes"], m["row_tokens"]
                bounds = m["cu_seqlens"]
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "doc_id": owner, "piece": piece, "pieces": pieces, "matrix": m["matrix"],
                            "matrix_row": a // row, "matrix_column": a % row, "n_tokens": b - a,
                            "ids_sha256": hashlib.sha256(m["ids"][a * width : b * width]).hexdigest(),
                        }
                        for owner, piece, pieces, a, b in zip(m["doc_ids"], m["piece"], m["pieces"], bounds, bounds[1:], strict=False)
                        if piece >= 0
                    ],
                    schema=schema,
                )

    ddl = (
        "doc_id long, piece int, pieces int, matrix string, matrix_row int, matrix_column int, n_tokens int, "
        "ids_sha256 string"
    )
    return spark.read.parquet(path).select(*_PACKED.names).mapInArrow(cut, ddl)
