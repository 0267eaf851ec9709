"""Quality rules: fixed counts, and a linear-chain conditional random field over a document's lines.

Every line is content or boilerplate. The field scores a line by its own features and by the label of the line before;
Viterbi decoding finds the best labelling of the whole document. A document stays if it passes the fixed rules and
content lines hold at least ``MIN_SHARE`` of its word characters. A line counts whole, however long it is.

Labels are known for documents and not for lines, so the labels of lines are latent. Fitting takes turns: the field's own
probabilities of the lines of a labelled document are tilted, no more than it takes, until lines of at least
``KNOWN_SHARE`` of its word bytes are expected to be content (good quality) or boilerplate (poor); then the field climbs
towards these probabilities. So a good document may hold boilerplate lines, and a poor one content. ``train_docs`` bounds
the labelled documents used, an equal number of either quality, chosen by a hash of their id among those of
``train_chars`` characters at most; a chosen document is learned from whole. Without labels of both kinds, ``PRIOR`` is
used as it is.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbside.llm.common import map_arrow, texts

TRAIN_DOCS, TRAIN_CHARS = 600, 1 << 14
MIN_SHARE = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
ROUNDS, EPOCHS, RATE, PULL = 6, 15, 0.3, 0.002
KNOWN_SHARE = 0.7
MAX_TILT, HALVINGS = 60.0, 16

FEATURES = ("bias", "symbols", "capitals", "marks", "digits", "repeats", "few words", "links", "seen before")
#: Weights of boilerplate before any fitting, and of (before, now) label pairs: 0 content, 1 boilerplate.
PRIOR = (np.array([-2.0, 12.0, 4.0, 6.0, 3.0, 4.0, 0.5, 3.0, 3.0]), np.array([[0.5, -0.5], [-0.5, 0.5]]))

_SPACE, _SYMBOL, _UPPER, _LOWER, _MARK, _DIGIT, _FOLLOW = 1, 2, 4, 8, 16, 32, 64
_KIND = np.zeros(256, np.uint8)
for _codes, _bit in ((b" \t\n\x0b\x0c\r", _SPACE), (SYMBOLS, _SYMBOL), (bytes(range(65, 91)), _UPPER),
                     (bytes(range(97, 123)), _LOWER), (b"!?;:_=~^/\\", _MARK), (b"0123456789", _DIGIT),
                     (bytes(range(128, 192)), _FOLLOW)):
    _KIND[list(_codes)] |= _bit


def line_features(line: bytes, words: list[bytes], seen: bool = False) -> list[float]:
    """Shares of a line's characters and words, in the order of FEATURES; ``seen`` in an earlier line of the document."""
    kinds = np.bincount(_KIND[np.frombuffer(line, np.uint8)], minlength=128)
    chars = max(1, len(line) - int(kinds[_SPACE]) - int(kinds[_FOLLOW]))
    letters = max(1, int(kinds[_UPPER] + kinds[_LOWER]))
    n = len(words)
    same = sum(a == b for a, b in pairwise(words))
    return [1.0, kinds[_SYMBOL] / chars, kinds[_UPPER] / letters, kinds[_MARK] / chars, kinds[_DIGIT] / chars,
            same / max(1, n - 1), float(n < 3), min(1.0, (line.count(b"http") + line.count(b"www.")) / max(1, n) * 10), float(seen)]


def steps_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features and word bytes of a document's lines; lines without a word have none."""
    rows, weights = [], []
    earlier: set[bytes] = set()
    for line in text.split(b"\n"):
        if words := line.split():
            rows.append(line_features(line, words, line in earlier))
            weights.append(sum(map(len, words)))
            earlier.add(line)
    return np.array(rows, float).reshape(-1, len(FEATURES)), np.array(weights, float)


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best labels for scores (steps, 2) and moves (before, now); ties go to content."""
    steps = scores.tolist()
    if not steps:
        return np.empty(0, np.int64)
    (a, b), (c, d) = moves.tolist()
    zero, one = steps[0]
    back = []
    for s0, s1 in steps[1:]:
        from0 = one + c > zero + a
        from1 = one + d > zero + b
        back.append((from0, from1))
        zero, one = s0 + (one + c if from0 else zero + a), s1 + (one + d if from1 else zero + b)
    label = int(one > zero)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return np.array(out[::-1])


class Chains:
    """Lines of many documents, sorted by place and then by document, the longest documents first.

    So the lines at one place of all documents are neighbours, and a pass over chains takes a step for all of them.
    """

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """``parts`` has features and sizes of each document's lines, at least one."""
        self.order = sorted(range(len(parts)), key=lambda i: -len(parts[i][0]))
        parts = [parts[i] for i in self.order]
        lengths = np.array([len(x) for x, _ in parts])
        self.widths = [int((lengths > t).sum()) for t in range(lengths[0])]
        self.starts = np.concatenate([[0], np.cumsum(self.widths)])
        self.chain = np.concatenate([np.arange(w) for w in self.widths])
        place = np.concatenate([[0], np.cumsum(lengths)])[self.chain] + np.repeat(np.arange(len(self.widths)), self.widths)
        self.x = np.concatenate([x for x, _ in parts])[place]
        self.size = np.concatenate([s / s.sum() for _, s in parts])[place]
        #: A line after the first of its document, and the line before it.
        self.later = np.arange(self.widths[0], len(place))
        self.before = self.later - np.repeat(self.widths[:-1], self.widths[1:])

    def marginals(self, scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each line's probability of boilerplate, and the expected pairs of labels, by forward and backward sums."""
        forward, backward = scores.copy(), np.zeros_like(scores)
        for t in range(1, len(self.widths)):
            now, before = slice(self.starts[t], self.starts[t + 1]), self.starts[t - 1]
            a = forward[before : before + self.widths[t]]
            forward[now] += np.logaddexp(a[:, :1] + moves[0], a[:, 1:] + moves[1])
        for t in range(len(self.widths) - 1, 0, -1):
            now, before = slice(self.starts[t], self.starts[t + 1]), self.starts[t - 1]
            b = scores[now] + backward[now]
            backward[before : before + self.widths[t]] = np.logaddexp(b[:, :1] + moves[:, 0], b[:, 1:] + moves[:, 1])
        total = np.logaddexp(*(forward + backward)[: self.widths[0]].T)[self.chain]
        one = np.exp(forward[:, 1] + backward[:, 1] - total)
        pairs = forward[self.before][:, :, None] + moves + (scores + backward)[self.later][:, None, :]
        return one, np.exp(pairs - total[self.later, None, None]).sum(axis=0)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.stack([np.zeros(len(self.x)), self.x @ weights], axis=1)

    def constrained(self, weights: np.ndarray, moves: np.ndarray, poor: np.ndarray, known: float) -> tuple[np.ndarray, np.ndarray]:
        """The marginals nearest to the field's whose expected share in each document is at least ``known``.

        ``poor`` has one truth per chain. The nearest distribution adds to every line a multiple of its size, one factor
        a document, which halving intervals finds; documents that meet the bound already have factor 0.
        """
        base = self.scores(weights)
        mean = np.bincount(self.chain, self.size) / np.bincount(self.chain)
        toward = np.where(poor, 1.0, -1.0)

        def tilted(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            scores = base.copy()
            scores[:, 1] += (toward * factor / mean)[self.chain] * self.size
            return self.marginals(scores, moves)

        def enough(one: np.ndarray) -> np.ndarray:
            share = np.bincount(self.chain, one * self.size)
            return np.where(poor, share, 1 - share) >= known

        low, high = np.zeros(len(poor)), np.where(enough(tilted(np.zeros(len(poor)))[0]), 0.0, MAX_TILT)
        for _ in range(HALVINGS):
            middle = (low + high) / 2
            met = enough(tilted(middle)[0])
            low, high = np.where(met, low, middle), np.where(met, middle, high)
        return tilted(high)


def fit(docs: list[tuple[str | None, int]], known: float = KNOWN_SHARE) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves from (text, quality) pairs, the labels of lines being latent."""
    parts, poor = [], []
    for text, quality in docs:
        x, size = steps_of((text or "").encode())
        if len(x):
            parts.append((x, size))
            poor.append(not quality)
    weights, moves = PRIOR[0].copy(), PRIOR[1].copy()
    if len(set(poor)) < 2:
        return weights, moves
    chains = Chains(parts)
    poor = np.array(poor)[chains.order]
    speed_w, speed_m = np.zeros_like(weights), np.zeros_like(moves)
    for _ in range(ROUNDS):
        one, pairs = chains.constrained(weights, moves, poor, known)
        for _ in range(EPOCHS):
            own, own_pairs = chains.marginals(chains.scores(weights), moves)
            to_w = chains.x.T @ (one - own) / len(own) - PULL * (weights - PRIOR[0])
            to_m = (pairs - own_pairs) / len(own) - PULL * (moves - PRIOR[1])
            speed_w += to_w**2
            speed_m += to_m**2
            weights += RATE * to_w / (np.sqrt(speed_w) + 1e-9)
            moves += RATE * to_m / (np.sqrt(speed_m) + 1e-9)
    return weights, moves


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS,
          train_chars: int = TRAIN_CHARS) -> tuple[np.ndarray, np.ndarray]:
    """Fit on ``train_docs`` labelled documents at most, half of either quality.

    These come to the driver, so none is longer than ``train_chars`` characters.
    """
    quality = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    short = docs.filter(F.char_length("text") <= train_chars).select("doc_id", "text")
    quality = quality.join(short.select("doc_id"), "doc_id", "left_semi")
    order = F.xxhash64("doc_id")
    chosen = None
    for q in (0, 1):
        part = quality.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(train_docs // 2)
        chosen = part if chosen is None else chosen.unionAll(part)
    rows = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.min("quality").alias("quality")).orderBy("doc_id").collect()
    return fit([(r.text, r.quality) for r in rows])


def counts(text: str) -> dict:
    """The fixed counts of a whole text."""
    data = text.encode()
    kinds = np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=128)
    words = data.split()  # splits at the six ASCII space characters only
    seen: set[bytes] = set()
    copies = 0
    for line in data.split(b"\n"):
        if line in seen:
            copies += 1
        elif line.strip():
            seen.add(line)
    return {
        "n_words": len(words), "word_chars": len(data) - int(kinds[_SPACE]) - int(kinds[_FOLLOW]),
        "n_symbols": int(kinds[_SYMBOL]), "n_dup_lines": copies, "n_repeat_words": repeated_words(words),
    }


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    keys = ids[:n]
    for i in range(1, window):
        # Pairs of numbers become numbers again, so a window's number stands for exactly its words.
        pair = keys * len(number) + ids[i : n + i]
        _, keys = np.unique(pair, return_inverse=True)
    often = np.bincount(keys)[keys] > 1
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : n + i] |= often
    return int(covered.sum())


def line_labels(text: str, weights: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each line that has a word: its label, 0 content and 1 boilerplate, and its word bytes."""
    x, size = steps_of(text.encode())
    return viterbi(np.stack([np.zeros(len(x)), x @ weights], axis=1), moves), size


def content_share(text: str, weights: np.ndarray, moves: np.ndarray) -> float:
    """Share of word bytes in lines that the field marks as content; 0 without words."""
    label, size = line_labels(text, weights, moves)
    return float(size[label == 0].sum() / size.sum()) if len(size) else 0.0


def judged(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, min_share: float = MIN_SHARE,
           train_chars: int = TRAIN_CHARS) -> DataFrame:
    """Per row: the counts, base_failed, content_share and kept. Null texts count as empty, and fail."""
    weights, moves = train(docs, labels, train_docs, train_chars)

    def work(batch: pa.RecordBatch) -> dict:
        rows = []
        for text in texts(batch):
            row = counts(text)
            row["base_failed"] = row["n_words"] < MIN_WORDS or 100 * row["n_repeat_words"] > MAX_REPEAT_PERCENT * row["n_words"]
            row["content_share"] = content_share(text, weights, moves)
            row["kept"] = not row["base_failed"] and row["content_share"] >= min_share
            rows.append(row)
        return {c: [r[c] for r in rows] for c in rows[0]} | {"doc_id": batch.column("doc_id")}

    return map_arrow(docs.select("doc_id", "text"), work,
                     "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                     "base_failed boolean, content_share double, kept boolean")
