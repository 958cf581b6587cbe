"""Personal data in text: contracted patterns, and a linear-chain conditional random field for what has no pattern.

The field labels tokens (runs of letters, runs of digits, single other characters) as outside, or as the first or a
later token of one of the added kinds. Its features are the shapes of a token and its neighbours, and which group of
cue words they are in. It is trained on a small labelled table; weights become whole numbers, so decoding is
exact. Viterbi runs over batches of token runs. Before that, a bound on what any segment can gain over
"outside" leaves out the tokens that no best path can label otherwise, which is nearly all of a text.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagedoor.llm.pii_examples import EXAMPLES, background

BASE = ("email", "ip", "card", "phone")
ADDED = ("name", "address", "birth", "account", "contact")
KINDS = BASE + ADDED
# Label 0 is outside; label 2k + 1 begins the k-th added kind, 2k + 2 goes on with it.
LABELS = 1 + 2 * len(ADDED)
# Neighbours that a token's features look at.
REACH = 2
# Texts and characters that are labelled together, at most; a longer text is a batch of its own.
BATCH_DOCS, BATCH_CHARS = 512, 1 << 20

# The contracted patterns. Attempts at one place don't begin again inside a run that just failed.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Groups of cue words; group 0 is no cue.
CUES = (
    "mr mrs ms miss dr prof herr frau madame monsieur mme señor señora don doña",
    "name named signed sincerely dear nom nombre appelle llamo patient customer contact geehrter geehrte",
    "street road lane avenue square drive straße strasse weg platz gasse rue boulevard calle plaza",
    "address adresse dirección lives live moved ship send wohnt wohnen habite vive",
    "born birth dob geboren geburtsdatum née né naissance nacido nacida nacimiento",
    "january february march april may june july august september october november december mai mars juillet mayo julio",
    "iban account konto cuenta compte ssn passport social security",
    "phone tel call mobile telefon téléphone teléfono fax",
    "email mail write",
    "at",
    "dot",
    "com org net",
    "number",
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each base kind that pass their conditions, by kind and start."""
    out = []
    free = 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        # A local part can't hold the mark, so what precedes the mark is all that the leftmost match can begin with.
        before = text[free : m.start()]
        local = len(before) - len(before.rstrip(_LOCAL))
        free = m.start() + 1
        if local:
            out.append(("email", m.start() - local, m.end()))
            free = m.end()
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37:
            digits = re.sub("[^0-9]", "", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# Classes of characters: nothing yet, space, line break, lower case or caseless letter, capital, digit, other, end of a text.
_NEW, _SPACE, _BREAK, _SMALL, _CAPITAL, _DIGIT, _OTHER, _END = range(8)
_LAST = 0x110000
# Word shapes by five lengths, digit runs by seven, ASCII marks each, other marks, end of text.
_WORD_BOUNDS = np.array([2, 3, 5, 8])
_DIGIT_BOUNDS = np.array([2, 3, 4, 5, 9, 16])
_MARKS_FROM = 5 * 5 + 7
SHAPES = _MARKS_FROM + 128 + 2
CLASSES = SHAPES * (len(CUES) + 1) * 3
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Tokens:
    """Tokens of a batch of texts: where they start and end, and the class of features each is in."""

    table = np.zeros(_LAST + 1, np.uint8)
    small = np.arange(_LAST + 1, dtype=np.uint32)

    def __init__(self, texts: list[str]):
        mark = np.full(REACH, _LAST, np.uint32)
        parts, self.offsets, at = [mark], [], REACH
        for text in texts:
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
            self.offsets.append(at)
            parts += [points, mark]
            at += len(points) + REACH
        points = np.concatenate(parts)
        kinds = self._kinds(points)
        # Letters in a run, digits in a run, any other character alone; spaces are no tokens.
        group = np.array([0, 0, 0, 1, 1, 2, 3, 4], np.uint8)[kinds]
        differs = np.concatenate([[True], group[1:] != group[:-1]])
        alone = group >= 3
        begins = (group > 0) & (differs | alone)
        ends = (group > 0) & (np.concatenate([differs[1:], [True]]) | alone)
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.is_end = group[self.starts] == 4
        self.classes = self._classes(points, kinds, group)

    @classmethod
    def _kinds(cls, points: np.ndarray) -> np.ndarray:
        kinds = cls.table[points]
        if not kinds.all():
            for p in np.unique(points[kinds == _NEW]).tolist():
                if p == _LAST:
                    cls.table[p] = _END
                    continue
                c = chr(p)
                kind = _SMALL if c.isalpha() else _DIGIT if "0" <= c <= "9" else _OTHER
                kind = _CAPITAL if c.isupper() and c.isalpha() else kind
                cls.table[p] = (_BREAK if c in "\n\r\x0b\x0c\x85\u2028\u2029" else _SPACE) if c.isspace() else kind
                low = c.lower()
                cls.small[p] = ord(low) if len(low) == 1 else p
            kinds = cls.table[points]
        return kinds

    def _classes(self, points: np.ndarray, kinds: np.ndarray, group: np.ndarray) -> np.ndarray:
        first, length = group[self.starts], self.ends - self.starts
        so_far = np.concatenate([[0], np.cumsum(kinds == _CAPITAL)])
        capitals = so_far[self.ends] - so_far[self.starts]
        leads = kinds[self.starts] == _CAPITAL
        # Small, capitalised, one capital, all capitals, mixed.
        form = np.select(
            [capitals == 0, (capitals == 1) & leads & (length > 1), (capitals == 1) & leads, capitals == length], [0, 1, 2, 3], 4
        )
        word = form * 5 + np.searchsorted(_WORD_BOUNDS, length, "right")
        digit = 25 + np.searchsorted(_DIGIT_BOUNDS, length, "right")
        mark = _MARKS_FROM + np.minimum(points[self.starts], 128)
        shape = np.select([first == 1, first == 2, first == 3], [word, digit, mark], SHAPES - 1)
        before = kinds[np.maximum(self.starts - 1, 0)]
        gap = np.select([before == _SPACE, before == _BREAK], [1, 2], 0)
        return ((shape * (len(CUES) + 1) + self._cues(points)) * 3 + gap).astype(np.int32)

    def _cues(self, points: np.ndarray) -> np.ndarray:
        keys, groups, longest = _CUE_TABLE
        hashes = word_hashes(self.small[points], self.starts, self.ends)
        near = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        found = (keys[near] == hashes) & (self.ends - self.starts <= longest)
        return np.where(found, groups[near], 0)


def word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each points[start:end], from prefix sums, modulo 2 ** 64."""
    with np.errstate(over="ignore"):
        powers = np.full(len(points) + 1, _BASE)
        powers[0] = 1
        powers = np.cumprod(powers)
        undo = np.full(len(points) + 1, _INVERSE)
        undo[0] = 1
        undo = np.cumprod(undo)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers[:-1])])
        return (sums[ends] - sums[starts]) * undo[starts]


def _cue_table() -> tuple[np.ndarray, np.ndarray, int]:
    words = [(w, k) for k, group in enumerate(CUES, 1) for w in group.split()]
    points = np.array([ord(c) for w, _ in words for c in w], np.uint32)
    ends = np.cumsum([len(w) for w, _ in words])
    starts = ends - np.array([len(w) for w, _ in words])
    hashes = word_hashes(points, starts, ends)
    order = np.argsort(hashes)
    return hashes[order], np.array([k for _, k in words])[order], max(len(w) for w, _ in words)


_CUE_TABLE = _cue_table()


def features(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shape, cue and gap of classes."""
    joint, gap = np.divmod(classes, 3)
    shape, cue = np.divmod(joint, len(CUES) + 1)
    return shape, cue, gap


def _allowed() -> np.ndarray:
    """Which label may follow which: a kind begins after outside, and goes on after itself."""
    ok = np.zeros((LABELS, LABELS), bool)
    ok[:, 0] = ok[0, 1::2] = True
    for k in range(len(ADDED)):
        ok[[2 * k + 1, 2 * k + 2], 2 * k + 2] = True
    return ok


ALLOWED = _allowed()
_NEVER = -(10**7)


@dataclass(frozen=True)
class Model:
    """Whole-number weights: ``emit[d]`` by class of the neighbour at distance d - REACH and label, ``move`` by labels."""

    emit: np.ndarray
    move: np.ndarray

    def scores(self, classes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores of all labels of the tokens ``at``; every one of them has ``REACH`` neighbours."""
        return sum(self.emit[d].take(classes.take(at + (d - REACH)), axis=0) for d in range(2 * REACH + 1))

    def possible(self, tokens: Tokens) -> np.ndarray:
        """Tokens that a best path may label; all others are outside in it.

        Labelled tokens form segments of one kind, with outside before and after. A segment gains what its first
        token, each later one, and the move out add over staying outside. If no segment of any kind that holds
        a token gains anything, the token is outside. The best start up to a token and the best
        end from it on are running extremes of running sums, so all segments are tried in linear time.
        """
        real = np.flatnonzero(~tokens.is_end)
        over = np.full((len(tokens.classes), LABELS), _NEVER, np.int64)
        over[real] = self.scores(tokens.classes, real)
        over -= over[:, :1] + self.move[0, 0]
        over[tokens.is_end] = 100 * _NEVER
        found = np.zeros(len(tokens.classes), bool)
        for k in range(len(ADDED)):
            b, i = 2 * k + 1, 2 * k + 2
            first = over[:, b] + self.move[0, b]
            later = over[:, i] + max(self.move[b, i], self.move[i, i])
            out = max(self.move[b, 0], self.move[i, 0]) - self.move[0, 0]
            sums = np.cumsum(later)
            begun = np.maximum.accumulate(first - sums)
            ended = np.maximum.accumulate(sums[::-1])[::-1]
            found |= begun + ended + out > 0
        return found & ~tokens.is_end

    def decode(self, tokens: Tokens) -> np.ndarray:
        """The labels of a best path, run by run of the tokens that may have one."""
        labels = np.zeros(len(tokens.classes), np.int8)
        maybe = np.flatnonzero(self.possible(tokens))
        if not len(maybe):
            return labels
        cuts = np.flatnonzero(np.diff(maybe) > 1) + 1
        firsts, lengths = maybe[np.r_[0, cuts]], np.diff(np.r_[0, cuts, len(maybe)])
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            # Runs of similar length together, as many as keep the table of ways back small.
            longest = max(int(lengths[order[at]]) * 2, 8)
            near = lengths[order[at : at + max(1, (1 << 20) // longest)]]
            upto = at + int(np.searchsorted(near, longest, "right"))
            some = order[at:upto]
            self._viterbi(tokens.classes, firsts[some], lengths[some], labels)
            at = upto
        return labels

    def _viterbi(self, classes: np.ndarray, firsts: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> None:
        steps, rows = int(lengths.max()), np.arange(len(firsts))
        back = np.zeros((steps, len(firsts), LABELS), np.int8)
        state = np.full((len(firsts), LABELS), _NEVER, np.int64)
        state[:, 0] = 0
        for t in range(steps):
            live = t < lengths
            paths = state[:, :, None] + self.move
            back[t] = paths.argmax(axis=1)
            here = paths.max(axis=1) + self.scores(classes, np.where(live, firsts + t, firsts))
            state = np.where(live[:, None], here, state)
        label = (state + self.move[:, 0]).argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            live = t < lengths
            labels[firsts[live] + t] = label[live]
            label = np.where(live, back[t][rows, label], label)


def parse_example(marked: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The text of a marked sentence, and its spans (kind, start, end)."""
    text, spans, at = "", [], 0
    for m in re.finditer(rf"\[({'|'.join(ADDED)}) ((?:[^\[\]]|\[at\]|\[dot\])+)\]", marked):
        text += marked[at : m.start()]
        spans.append((m[1], len(text), len(text) + len(m[2])))
        text, at = text + m[2], m.end()
    return text + marked[at:], spans


def labels_of(tokens: Tokens, text: int, spans: list[tuple[str, int, int]]) -> dict[int, int]:
    """Labels of the tokens of one text of a batch that lie in spans."""
    out = {}
    at = tokens.offsets[text]
    for kind, start, end in spans:
        inside = np.flatnonzero((tokens.starts >= at + start) & (tokens.ends <= at + end))
        for n, i in enumerate(inside):
            out[int(i)] = 2 * ADDED.index(kind) + (1 if n == 0 else 2)
    return out


def train(examples: list[str] | None = None, rounds: int = 80, decay: float = 0.02, scale: int = 1000) -> Model:
    """Weights that maximise the likelihood of the labelled table, less ``decay`` times their squares.

    Full-batch steps of a fixed number, sign by sign with a step size for each weight (resilient
    propagation); nothing is random. Sentences are padded and go through forward and backward sums together.
    """
    parsed = [parse_example(e) for e in (EXAMPLES + background() if examples is None else examples)]
    tokens = Tokens([text for text, _ in parsed])
    truth = np.zeros(len(tokens.classes), np.int64)
    for i, (_, spans) in enumerate(parsed):
        for token, label in labels_of(tokens, i, spans).items():
            truth[token] = label
    # Sentences lie between end marks; the mark after a sentence is its last step and is outside.
    marks = np.flatnonzero(tokens.is_end)
    firsts = marks[:-1][np.diff(marks) > 1] + 1
    lasts = marks[1:][np.diff(marks) > 1]
    steps = int((lasts - firsts).max()) + 1
    at = np.minimum(firsts[:, None] + np.arange(steps), lasts[:, None])
    live = (firsts[:, None] + np.arange(steps)) <= lasts[:, None]
    # Everything of features is by live position: a row of feature numbers each.
    window = np.clip(at[live][:, None] + np.arange(-REACH, REACH + 1), 0, len(tokens.classes) - 1)
    parts = features(tokens.classes[window])
    sizes = (SHAPES, len(CUES) + 1, 3)
    blocks = [(d, p) for d in range(2 * REACH + 1) for p in range(3)]
    starts = np.cumsum([0] + [sizes[p] for _, p in blocks])
    index = np.stack([starts[k] + parts[p][:, d] for k, (d, p) in enumerate(blocks)], axis=-1)
    n, labels = len(firsts), np.where(live, truth[at], 0)
    weights = np.zeros((starts[-1], LABELS))
    moves = np.zeros((LABELS, LABELS))

    def counts(mass: np.ndarray) -> np.ndarray:
        flat = index.ravel()
        return np.stack(
            [np.bincount(flat, np.repeat(mass[:, k], len(blocks)), len(weights)) for k in range(LABELS)], axis=1
        )

    seen = counts(np.eye(LABELS)[labels[live]])
    seen_moves = np.zeros_like(moves)
    before = np.concatenate([np.zeros((n, 1), np.int64), labels[:, :-1]], axis=1)
    np.add.at(seen_moves, (before[live], labels[live]), 1.0)

    size = {"w": np.full_like(weights, 0.05), "m": np.full_like(moves, 0.05)}
    last = {"w": np.zeros_like(weights), "m": np.zeros_like(moves)}
    rows = np.arange(n)
    for _ in range(rounds):
        score = np.zeros((n, steps, LABELS))
        score[live] = weights[index].sum(axis=1)
        local = np.exp(score - score.max(axis=2, keepdims=True))
        move = np.exp(moves) * ALLOWED
        # Forward and backward sums, each step scaled to add up to one.
        ahead, scales = np.zeros((steps + 1, n, LABELS)), np.ones((steps, n, 1))
        ahead[0, :, 0] = 1.0
        for t in range(steps):
            step = (ahead[t] @ move) * local[:, t]
            scales[t] = step.sum(axis=1, keepdims=True)
            ahead[t + 1] = np.where(live[:, t, None], step / scales[t], ahead[t])
        # A path ends outside, at the end mark.
        rest = np.zeros((n, LABELS))
        rest[:, 0] = 1.0
        whole = ahead[steps, rows, 0][:, None]
        mass, pairs = np.zeros((n, steps, LABELS)), np.zeros_like(moves)
        for t in range(steps - 1, -1, -1):
            on = live[:, t, None]
            mass[:, t] = np.where(on, ahead[t + 1] * rest / whole, 0.0)
            onward = np.where(on, local[:, t] * rest / scales[t], 0.0)
            pairs += move * ((ahead[t] / whole).T @ onward)
            rest = np.where(on, onward @ move.T, rest)
        slopes = {"w": seen - counts(mass[live]) - 2 * decay * weights, "m": (seen_moves - pairs) * ALLOWED - 2 * decay * moves}
        for name, value in (("w", weights), ("m", moves)):
            same = np.sign(slopes[name] * last[name])
            size[name] = np.clip(size[name] * np.select([same > 0, same < 0], [1.2, 0.5], 1.0), 1e-4, 0.5)
            slopes[name] = np.where(same < 0, 0.0, slopes[name])
            value += np.sign(slopes[name]) * size[name]
            last[name] = slopes[name]
    classes = np.arange(CLASSES)
    shape, cue, gap = features(classes)
    emit = []
    for d in range(2 * REACH + 1):
        s, c, g = (starts[blocks.index((d, p))] for p in range(3))
        emit.append(np.rint(scale * (weights[s + shape] + weights[c + cue] + weights[g + gap])).astype(np.int64))
    return Model(np.stack(emit), np.where(ALLOWED, np.rint(scale * moves), _NEVER).astype(np.int64))


def added_spans(tokens: Tokens, labels: np.ndarray, texts: int) -> list[list[tuple[str, int, int]]]:
    """Spans of labelled tokens by text."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(texts)]
    named = np.flatnonzero(labels)
    owners = np.searchsorted(tokens.offsets, tokens.starts[named], "right") - 1
    for i, owner in zip(named.tolist(), owners.tolist(), strict=True):
        label, at = int(labels[i]), tokens.offsets[owner]
        start, end = int(tokens.starts[i]) - at, int(tokens.ends[i]) - at
        if label % 2:
            out[owner].append((ADDED[label // 2], start, end))
        else:
            kind, begun, _ = out[owner][-1]
            out[owner][-1] = (kind, begun, end)
    return out


def all_spans(texts: list[str], model: Model) -> list[list[tuple[str, int, int]]]:
    """Base spans of each text, then the added ones that touch no base span, by kind and start."""
    tokens = Tokens(texts)
    found = added_spans(tokens, model.decode(tokens), len(texts))
    out = []
    for text, more in zip(texts, found, strict=True):
        base = base_spans(text)
        taken = sorted((a, b) for _, a, b in base)
        starts = [a for a, _ in taken]
        past = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []

        def is_free(a: int, b: int, starts=starts, past=past) -> bool:
            before = int(np.searchsorted(starts, b)) - 1
            return before < 0 or past[before] <= a

        kept = [s for s in more if is_free(s[1], s[2])]
        out.append(base + sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1])))
    return out


def _batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a bounded number of texts and characters, with their texts; null is empty."""
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        at = 0
        while at < len(texts):
            upto, size = at + 1, len(texts[at])
            while upto < len(texts) and upto - at < BATCH_DOCS and size + len(texts[upto]) <= BATCH_CHARS:
                size += len(texts[upto])
                upto += 1
            yield batch.slice(at, upto - at), texts[at:upto]
            at = upto


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def personal_spans(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans), one row per row of ``docs``; a span has kind, start and end, in code points, end exclusive.

    Base kinds come first, in order of kinds, then added kinds; within a kind by start. Base spans of different
    kinds may overlap; an added span that overlaps a base span is left out.

    - Null texts are empty, and empty texts have no spans. Null and repeated ids and equal rows are kept as they are.
    - Texts of any length are read whole; what a text gives doesn't depend on its neighbours. Equal scores stay outside.
    - An empty table gives an empty result; columns other than the two named are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _batches(batches, 1):
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in all_spans(texts, shared.value)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, pa.list_(_SPAN))], ["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind: string, start: int, end: int>>")


def redacted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one, named by the first.

    Null texts stay null. All other columns are as they were.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _batches(batches, place):
            new: list[str | None] = []
            for value, spans, there in zip(texts, all_spans(texts, shared.value), part.column(place).is_valid().to_pylist(), strict=True):
                out, at = [], 0
                for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
                    if a >= at:
                        out += [value[at:a], f"[{kind}]"]
                    at = max(at, b)
                new.append("".join([*out, value[at:]]) if there else None)
            columns = [*part.columns]
            columns[place] = pa.array(new, part.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def digest_columns(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of :func:`personal_spans`."""

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(keep):
        return F.size(F.filter("spans", keep)).cast("bigint")

    def of_kind(kind):
        return lambda s: s["kind"] == kind

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *(count(of_kind(k)).alias(f"n_{k}") for k in BASE),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count(lambda s: ~s["kind"].isin(*BASE)).alias("n_added"),
    )
