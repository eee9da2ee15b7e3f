"""Toxicity: a learned lexicon in a trie, met by Levenshtein automata, scored in context.

1. From a bounded sample of labelled rows, near copies removed, every word and word beginning is
   counted in toxic and in other documents (a Spark aggregation). Entries of the lexicon are the
   words, or open stems, that toxic documents favour strongly.
2. Each word of a text runs through the trie of the lexicon, words and stems, together with the
   Levenshtein automaton of one edit or swap (entries of ``MIN_FUZZY`` letters or more), so misspelled
   entries and misspelled forms of a stem are found too.
3. Hits are weighed by their context: inside quotation marks or not, and how many hits stand within
   ``WINDOW`` words. A small logistic regression turns these into a score from 0 to 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import slices, words
from .quality import labelled_sample

MIN_FUZZY = 5
STEM = range(3, 9)
WINDOW = 8
_TOKEN = re.compile(r"[\"“”„«»]|\w+|\n")
_QUOTES = set("\"“”„«»")
FEATURES = 8
MEMO = 200_000


class Lexicon:
    """Entries: {string: weight}. A string that ends in ``$`` is a whole word, others are stems (any
    continuation matches). Words of ``MIN_FUZZY`` letters or more match within one edit: a letter
    missing, added or replaced. With ``loose``, which ``train`` sets, so do stems, and two neighbouring
    letters that changed places are one edit."""

    def __init__(self, entries: dict[str, float], loose: bool = False):
        self.stems = {e: w for e, w in entries.items() if not e.endswith("$")}
        self.stem_sizes = sorted({len(s) for s in self.stems})
        self.words = {e[:-1]: w for e, w in entries.items() if e.endswith("$")}
        self.loose = loose
        self.trie: dict = {}
        self.memo: dict = {}
        marks = [(self.words, "$"), (self.stems, "*")][:1 + loose]
        for kind, mark in marks:
            for entry, weight in kind.items():
                node = self.trie
                for ch in entry:
                    node = node.setdefault(ch, {})
                node[mark] = weight
        # One edit leaves the first or the second half of an entry whole, a swap in the middle all but the
        # letters beside it: a cheap test before the walk. The second half starts at most one letter off.
        self.heads, self.tails = set(), {}
        for entry in [x for kind, _ in marks for x in kind if len(x) >= MIN_FUZZY]:
            h = len(entry) // 2
            self.heads |= {entry[:h], entry[:h - 1] + entry[h]} if loose else {entry[:h]}
            self.tails.setdefault((h, len(entry) - h), set()).add(entry[h:])
        self.head_sizes = sorted({len(x) for x in self.heads})

    def find(self, word: str) -> tuple[int, float] | None:
        """(edits, weight) of the best entry for a lower-case word, or None."""
        w = self.words.get(word)
        if w is not None:
            return 0, w
        for n in self.stem_sizes:
            w = self.stems.get(word[:n])
            if w is not None and len(word) >= n:
                return 0, w
        if not (any(word[:n] in self.heads for n in self.head_sizes)
                or any(word[h + d:h + d + n] in some for (h, n), some in self.tails.items() for d in (-1, 0, 1))):
            return None
        found = self._walk(word)
        return (1, found) if found is not None else None

    def _known(self, token: str) -> tuple[int, float] | None:
        """``find`` with a memo, emptied when it holds ``MEMO`` words."""
        found = self.memo.get(token, 0)
        if found == 0:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            found = self.memo[token] = self.find(token)
        return found

    def _walk(self, word: str) -> float | None:
        """Walk trie and automaton together. A state of the automaton is the set of (letters of
        ``word`` read, edits made), at most one edit; 2 edits stand for a swap whose second letter is due."""
        best = None
        stack = [(self.trie, frozenset({(0, 0), (1, 1)}), 0)]
        n = len(word)
        while stack:
            node, state, depth = stack.pop()
            if depth >= MIN_FUZZY:
                if "$" in node and any((i == n and e < 2) or (i == n - 1 and e == 0) for i, e in state):
                    best = max(best or node["$"], node["$"])
                if "*" in node and any(i <= n and e < 2 for i, e in state):
                    best = max(best or node["*"], node["*"])
            for ch, child in node.items():
                if ch in "$*":
                    continue
                new = set()
                for i, e in state:
                    if e == 2:
                        if word[i] == ch:
                            new.add((i + 2, 1))     # the second of two letters that changed places
                        continue
                    if i < n and word[i] == ch:
                        new.add((i + 1, e))
                    if e == 0:
                        new.add((i, 1))             # a letter of the entry is missing
                        if i < n:
                            new.add((i + 1, 1))     # another letter stands in its place
                        if i + 1 < n and word[i + 1] == ch:
                            new.add((i + 2, 1))     # an extra letter in the word
                            if self.loose:
                                new.add((i, 2))
                if new:
                    stack.append((child, frozenset(new), depth + 1))
        return best

    def features(self, text: str | None) -> list[float]:
        """Counts by (exact or misspelled, plain or quoted), strongest weight, crowding, length."""
        if not text:
            return [0.0] * FEATURES
        kind = [0.0] * 4
        top, at, places, inside = 0.0, 0, [], False
        tokens = _TOKEN.findall(text.lower())
        hits = {t: h for t in set(tokens) if (h := self._known(t))}
        if not hits:
            return [0.0] * FEATURES
        find = hits.get
        for token in tokens:
            if token == "\n":
                inside = False
            elif token in _QUOTES:
                inside = not inside
            else:
                at += 1
                hit = find(token)
                if hit:
                    kind[2 * hit[0] + inside] += 1
                    if not inside:
                        top = max(top, hit[1] if hit[0] == 0 else hit[1] / 2)
                        places.append(at)
        crowd = sum(b - a <= WINDOW for a, b in zip(places, places[1:]))
        return [float(kind[0] > 0), *np.log1p(kind).tolist(), top / 5, float(np.log1p(crowd)),
                float(kind[0] > 0) * float(np.log1p(at)) / 5]


def _terms(sample: DataFrame) -> DataFrame:
    """(sign1, sign2, toxic, terms) of (text, toxic): the distinct words and word beginnings of each
    document, and the two smallest hashes of its word runs (equal in near copies)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            w = words(part.column(0))
            at, h = w.windows(w.hashes(), 3)
            first = np.searchsorted(at, w.first)
            one, two, terms = [], [], []
            for d, text in enumerate(part.column(0)):
                own = h[first[d]:first[d + 1]]
                salt = np.uint64(0x9E3779B97F4A7C15)
                one.append(int(own.min().view(np.int64)) if len(own) else hash_text(text.as_py()))
                two.append(int((own * salt).min().view(np.int64)) if len(own) else one[-1])
                got = set()
                for word in set(re.findall(r"\w+", (text.as_py() or "").lower())):
                    got.add(word + "$")
                    got.update(word[:n] for n in STEM if n <= len(word))
                terms.append(sorted(got))
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64()), part.column(1),
                                              pa.array(terms, pa.list_(pa.string()))],
                                             names=["sign1", "sign2", "toxic", "terms"])
    return sample.select("text", "toxic").mapInArrow(run, "sign1 long, sign2 long, toxic int, terms array<string>")


def hash_text(text: str | None) -> int:
    import zlib
    return zlib.crc32((text or "").encode())


def choose_entries(counts: dict[str, tuple[int, int]], toxic: int, other: int, ratio: float = 20.0) -> dict[str, float]:
    """Lexicon from {term: (toxic documents, other documents)}.

    From the shortest strongly favoured beginning, go on to a longer one (or to the word's end) while
    that keeps nine tenths of the toxic documents: ``idi`` becomes the word ``idiot``, while a stem
    with many endings stays a stem.
    """
    least = 4 if toxic < 200 else 6

    def favoured(c):
        return c[0] >= least and (c[0] + 0.5) / (toxic + 1) >= ratio * (c[1] + 0.5) / (other + 1)

    good = {t: c for t, c in counts.items() if favoured(c)}
    after: dict[str, list[str]] = {}
    for t in good:
        for n in range(1, len(t)):
            if t[:n] in good and not t[:n].endswith("$"):
                after.setdefault(t[:n], []).append(t)
    entries = {}
    for t, c in good.items():
        stem = t.rstrip("$")
        if any(stem[:n] in good and stem[:n] != t for n in STEM if n <= len(stem)):
            continue  # a shorter beginning starts the walk
        now = t
        while True:
            longer = [x for x in after.get(now, []) if good[x][0] >= 0.9 * good[now][0]]
            if not longer:
                break
            now = max(longer, key=lambda x: (x.endswith("$"), good[x][0], len(x), x))
            if now.endswith("$"):
                break
        a, b = good[now]
        entries[now] = float(np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (other + 1)))
    return entries


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 30) -> np.ndarray:
    """Weights with the intercept last, by Newton steps on the ridge likelihood."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, pen = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    for _ in range(rounds):
        p = 0.5 * (1 + np.tanh(x @ w / 2))
        hess = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + pen
        step = np.linalg.solve(hess, x.T @ (y - p) - pen @ w)
        w = w + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return w


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _featured(df: DataFrame, lexicon: Lexicon, keep: list[str], weights: np.ndarray | None) -> DataFrame:
    """Feature rows (no weights) or scores of ``df``."""
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    schema += ", x array<double>" if weights is None else ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            x = [lexicon.features(t.as_py()) for t in part.column(part.schema.get_field_index("text"))]
            if weights is None:
                out = pa.array(x, pa.list_(pa.float64()))
            else:
                t = np.array(x).reshape(-1, FEATURES) @ weights[:-1] + weights[-1]
                out = pa.array(0.5 * (1 + np.tanh(t / 2)))
            cols = [part.column(part.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(cols + [out], names=keep + ["x" if weights is None else "score"])

    return df.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def train(labelled: DataFrame, max_terms: int = 20000) -> tuple[Lexicon, np.ndarray]:
    """(lexicon, logistic weights) from a bounded sample of (text, toxic) rows.

    ``max_terms`` bounds the favoured terms that come to the driver. Without toxic rows the lexicon is
    empty and every score is small.
    """
    spread = labelled.repartition(8).checkpoint()
    single = _terms(spread).dropDuplicates(["sign1"]).dropDuplicates(["sign2"]).checkpoint()
    size = single.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).collect()[0]
    toxic, other = int(size["t"]), int(size["n"] - size["t"])
    rows = (single.select("toxic", F.explode("terms").alias("term")).groupBy("term")
            .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
            .where("t >= 4 and t * 5 > c").orderBy(F.desc("t"), "term").limit(max_terms).collect())
    lexicon = Lexicon(choose_entries({r["term"]: (r["t"], r["c"]) for r in rows}, toxic, other), loose=True)
    seen = _featured(spread, lexicon, ["toxic"], None).collect()
    if not seen:
        return lexicon, np.array([0.0] * FEATURES + [-3.0])
    return lexicon, fit_logistic(np.array([r["x"] for r in seen]), np.array([float(r["toxic"] > 0) for r in seen]))


def toxicity_report(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; null and empty texts score as
    texts without a hit. Repeated rows and labels are used as they come."""
    slim = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    sample = labelled_sample(slim, labels.where(~held_out(F.col("doc_id"))), "toxic", sample_rows)
    lexicon, weights = train(sample.withColumnRenamed("label", "toxic"))
    return (_featured(slim, lexicon, ["doc_id", "held_out"], weights)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
