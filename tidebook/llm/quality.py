"""Quality classifier from weak labels: heuristic labellers, their accuracies by EM, a hashed linear scorer.

Each labeller votes good, bad or nothing on a text, from shares of its words. Expectation-maximisation
estimates how often every labeller votes what on good and on bad texts, from the counts of all vote
patterns over all documents; a pattern's posterior is the weak label of its texts. The labels train a
logistic scorer on hashed word features, which judges every document. Words and stems that
mark toxic texts are learnt from labelled rows, where there are any. A document is rejected as of low quality
when both its posterior and its score say so, or as toxic.

Fitting uses at most `TRAIN_ROWS` documents for each scorer, chosen by a hash; the label model
is fitted on all. The model has 2 ** BITS weights whatever the input.

Null and empty texts have no words: every labeller is silent, the posterior is the prior, the score 1
(nothing is held against them). Repeated rows get equal scores; other columns pass through `keep_good`.
An empty table fits a model that keeps everything.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm import base
from tidebook.llm.cuckoo import mixed

BITS = 18
HASH_BITS = 29
STEM = 5
TRAIN_ROWS = 8000
EPOCHS = 12
TOXIC = 0.5
RARE = 50
LIFT = 20
#: Nats of evidence that make a text as likely toxic as not. A word and its stem tell the same, so each counts half.
EVIDENCE, HALF = 2.5, 0.5
SKETCH = 8
CACHE = 1 << 19
SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()\-]")

# Frequent function words of English, French, German and Spanish.
COMMON = frozenset(
    "the of and to in a is that it on for was be with as at this by are an from or "
    "de la le les et des en un une que pour dans est du qui par sur pas au avec il ne se "
    "der die das und den von zu mit dem ist ein eine nicht auf sich für als auch im es "
    "el los las y del con una por su para al lo como más o".split()
)

LONGEST = max(map(len, COMMON))

# One bit per property of a word.
UPPER, LOUD, SYMBOL, BARE, STOP, CLOSED = (1 << i for i in range(6))
FLAG_BITS = 6


def word_flags(word: str) -> int:
    core = word.rstrip(".,;:!?")
    tail = len(word) - len(core)
    stop = STOP * (tail < 2 and len(core) <= LONGEST and core.lower() in COMMON)
    closed, loud = CLOSED * (word[-1] in ".,;:"), LOUD * (word.count("!") > 1)
    upper = UPPER * (len(core) > 1 and core.isupper())
    if core.isalpha():
        return stop | closed | loud | upper
    letters = word.upper() != word.lower() or any(c.isalpha() for c in word)
    bare = BARE * (not any(c.isalnum() for c in word))
    return stop | closed * letters | loud | upper | bare | SYMBOL * (letters and bool(SYMBOLS.search(word)))


class WordMarks(dict):
    """Flags of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = flags = word_flags(word) | (zlib.crc32(word.encode()) << FLAG_BITS)
        return flags


class WordFacts(dict):
    """Flags and hashes of words and of their first letters packed into one number, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        low = word.strip(".,;:!?").lower()
        packed = 0
        for name in (f"w {low}", f"p {low[:STEM]}"):
            packed = packed << HASH_BITS | xxhash.xxh3_64_intdigest(name) & (1 << HASH_BITS) - 1
        self[word] = packed = packed << FLAG_BITS | word_flags(word)
        return packed


def distinct_of(numbers: np.ndarray) -> np.ndarray:
    """The distinct ones of some numbers, in order."""
    ordered = np.sort(numbers)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def word_hashes(distinct: np.ndarray) -> np.ndarray:
    """The distinct hashes of the words and stems of a text."""
    mask = np.uint64((1 << HASH_BITS) - 1)
    return distinct_of(np.concatenate([(distinct >> np.uint64(FLAG_BITS + HASH_BITS * i)) & mask for i in range(2)])).astype(np.int64)


def hashed(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name) & (1 << BITS) - 1


#: The flag values with each bit set.
HAS = [np.array([v for v in range(1 << FLAG_BITS) if v >> i & 1]) for i in range(FLAG_BITS)]
SHARES = ("upper", "loud", "symbol", "bare", "stop", "closed", "again", "distinct")


def shares_of(packed: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Shares of words with each property, of words equal to the one before, and of distinct words."""
    size = len(packed)
    flags = np.bincount((packed & np.uint64((1 << FLAG_BITS) - 1)).astype(np.int64), minlength=1 << FLAG_BITS)
    own = [flags[HAS[i]].sum() / size for i in range(FLAG_BITS)]
    again = np.count_nonzero(packed[1:] == packed[:-1]) / size
    return np.array([*own, again, len(distinct) / size])


def votes_of(size: int, share: np.ndarray) -> str:
    """A letter per labeller: g for good, b for bad, - for nothing."""
    upper, loud, symbol, bare, stop, closed, again, distinct = share
    long = size >= 20

    def vote(bad: bool, good: bool) -> str:
        return "b" if bad else "g" if good else "-"

    return "".join(
        (
            vote(upper > 0.3, long and upper < 0.1),
            vote(loud > 0.08, long and loud < 0.02),
            vote(symbol > 0.15, long and symbol < 0.05),
            vote(bare > 0.15, long and bare < 0.05),
            vote(long and stop < 0.04, stop > 0.12),
            vote(long and closed < 0.01, 0.02 < closed < 0.4),
            vote(again > 0.12, long and again < 0.05),
            vote(long and distinct < min(0.4, 12 / size**0.5), long and distinct > 0.45),
        )
    )


LABELLERS = 8


def fit_accuracies(counts: dict[str, int], rounds: int = 100) -> tuple[float, np.ndarray]:
    """Prior of good and P(vote | class) as an array (labeller, class, vote), by EM over pattern counts."""
    patterns = [p for p in counts if p]
    if not patterns:
        return 0.5, np.full((LABELLERS, 2, 3), 1 / 3)
    votes = np.array([["b-g".index(c) for c in p] for p in patterns])
    weight = np.array([counts[p] for p in patterns], dtype=float)
    bad = (votes == 0).sum(axis=1)
    good = np.where(bad >= 2, 0.05, np.where(bad == 1, 0.7, 0.98))
    rows = np.arange(LABELLERS)
    for _ in range(rounds):
        mass = np.stack([weight * (1 - good), weight * good])
        chance = np.full((LABELLERS, 2, 3), 1.0)
        for label in range(2):
            for vote in range(3):
                chance[:, label, vote] += (mass[label][:, None] * (votes == vote)).sum(axis=0)
        chance /= chance.sum(axis=2, keepdims=True)
        prior = (mass[1].sum() + 1) / (weight.sum() + 2)
        fresh = posteriors(votes, prior, chance, rows)
        if np.abs(fresh - good).max() < 1e-9:
            break
        good = fresh
    return float(prior), chance


def posteriors(votes: np.ndarray, prior: float, chance: np.ndarray, rows: np.ndarray) -> np.ndarray:
    one, two = (np.log(chance[rows, label, votes]).sum(axis=1) for label in range(2))
    return 1 / (1 + np.exp(np.clip(one - two + np.log(1 - prior) - np.log(prior), -700, 700)))


def features_of(hashes: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Hashed features of a text: words, stems, and every share in tenths."""
    tenths = [hashed(f"{name} {int(10 * value)}") for name, value in zip(SHARES, share, strict=True)]
    return np.concatenate([hashes & (1 << BITS) - 1, tenths])


def read_text(text: str, known: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The packed words of a text, the distinct ones of them, and their shares."""
    words = text.split()
    if not words:
        return None
    packed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    distinct = distinct_of(packed)
    return packed, distinct, shares_of(packed, distinct)


def ballots(docs: DataFrame) -> DataFrame:
    """The vote pattern of every document; empty for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordMarks()
        for batch in batches:
            read = (read_text(t, known) for t in base.texts(batch))
            votes = [votes_of(len(r[0]), r[2]) if r else "" for r in read]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(votes, pa.string())], names=["doc_id", "votes"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, votes string")


def fit_scorer(rows: DataFrame, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of a logistic scorer on hashed features of a bounded table (text, label between 0 and 1); the last is the bias."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordFacts()
        examples = []
        for batch in batches:
            for text, label in zip(base.texts(batch), batch.column("label").to_pylist(), strict=True):
                if (read := read_text(text, known)) is not None:
                    examples.append((features_of(word_hashes(read[1]), read[2]), label))
        weights = np.zeros((1 << BITS) + 1)
        square = np.full((1 << BITS) + 1, 1e-6)
        rng = np.random.default_rng(1)
        share = np.clip(np.mean([y for _, y in examples]) if examples else 0.5, 0.01, 0.99)
        for _ in range(epochs):
            for i in rng.permutation(len(examples)):
                at, label = examples[i]
                scale = 1 / np.sqrt(len(at))
                margin = weights[at].sum() * scale + weights[-1]
                error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label) * (0.5 / share if label > 0.5 else 0.5 / (1 - share))
                step = error * scale
                square[at] += step * step
                weights[at] -= 0.3 * step / np.sqrt(square[at])
                square[-1] += error * error
                weights[-1] -= 0.1 * error / np.sqrt(square[-1])
        used = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights[used])], names=["at", "weight"])

    found = rows.select("text", "label").repartition(1).sortWithinPartitions("text", "label").mapInArrow(train, "at long, weight double").toArrow()
    weights = np.zeros((1 << BITS) + 1, dtype=np.float32)
    weights[found["at"].to_numpy()] = found["weight"].to_numpy()
    return weights


def sketch_of(packed: np.ndarray) -> set[tuple[int, int]]:
    """Least hashes of the word pairs of a text under several salts; near copies share some."""
    pairs = packed[:-1] * np.uint64(31) + packed[1:] if len(packed) > 1 else packed
    return {(salt, int(mixed(pairs + np.uint64(salt << 40)).min())) for salt in range(SKETCH)}


Lexicon = tuple[np.ndarray, np.ndarray, np.ndarray]


def fit_lexicon(rows: DataFrame) -> Lexicon:
    """Hashes of words and stems that mark toxic texts, the share of toxic texts that have each, and how often one
    of the distinct words and stems of another text is each, from a bounded table (text, label).

    A mark is found in at least one in `RARE` toxic texts and at least `LIFT` times as often as in others.
    Of near copies, which would turn all words of one text into marks, only one is counted.
    """

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordFacts()
        seen: dict[bool, list[np.ndarray]] = {True: [], False: []}
        met: set[tuple[int, int]] = set()
        for batch in batches:
            for text, label in zip(base.texts(batch), batch.column("label").to_pylist(), strict=True):
                read = read_text(text, known)
                if read is None or not met.isdisjoint(sketch := sketch_of(read[0])):
                    continue
                met |= sketch
                seen[label > 0.5].append(word_hashes(read[1]))
        toxic, clean = seen[True], seen[False]
        names, count = np.unique(np.concatenate([*toxic, np.empty(0, np.int64)]), return_counts=True)
        common = count >= max(3, len(toxic) / RARE)
        names, count = names[common], count[common]
        others, again = np.unique(np.concatenate([*clean, np.empty(0, np.int64)]), return_counts=True)
        at = np.searchsorted(others, names)
        elsewhere = np.where(np.append(others, -1)[at] == names, np.append(again, 0)[at], 0)
        lift = (count + 0.1) / max(1, len(toxic)) / ((elsewhere + 0.5) / max(1, len(clean)))
        marks = lift >= LIFT
        share, other = count[marks] / (len(toxic) + 1), (elsewhere[marks] + 0.5) / max(1, sum(map(len, clean)))
        yield pa.RecordBatch.from_arrays([pa.array(names[marks]), pa.array(share), pa.array(other)], names=["at", "share", "other"])

    found = rows.select("text", "label").repartition(1).sortWithinPartitions("text", "label").mapInArrow(train, "at long, share double, other double").toArrow().sort_by("at")
    return found["at"].to_numpy(), found["share"].to_numpy(), found["other"].to_numpy()


class Model:
    """Everything fitted: the labellers' accuracies and the weights of the scorers."""

    def __init__(self, prior: float, chance: np.ndarray, quality: np.ndarray, lexicon: Lexicon | None) -> None:
        self.prior, self.chance, self.quality, self.lexicon = prior, chance, quality, lexicon

    def posterior(self, votes: str) -> float:
        if not votes:
            return self.prior
        coded = np.array([["b-g".index(c) for c in votes]])
        return float(posteriors(coded, self.prior, self.chance, np.arange(LABELLERS))[0])

    def evidence(self, hashes: np.ndarray) -> float:
        """How much likelier the marks that a text has and lacks are in a toxic text than in another of its size, in nats.

        A toxic text of any length has each mark with its share, and any text has it by chance, the more so the
        longer it is: in a very long one a mark says nothing.
        """
        if self.lexicon is None or not len(self.lexicon[0]):
            return -np.inf
        marks, share, other = self.lexicon
        at = np.minimum(np.searchsorted(hashes, marks), len(hashes) - 1)
        has = hashes[at] == marks
        chance = -np.expm1(-len(hashes) * other[has])
        present = np.log(share[has] / chance + 1 - share[has])
        return HALF * float(present.sum() + np.log1p(-share[~has]).sum())

    def toxic(self, hashes: np.ndarray) -> float:
        """How likely a text is toxic by its marks."""
        return float(1 / (1 + np.exp(np.clip(EVIDENCE - self.evidence(hashes), -700, 700))))


def chosen(rows: DataFrame, limit: int) -> DataFrame:
    """A bounded sample of rows, by a hash of the document's id."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, labels: DataFrame | None = None, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit the label model on all documents, and the scorers on bounded samples."""
    cast = base.materialize(ballots(docs), "ballots")
    counts = {r["votes"]: r["count"] for r in cast.groupBy("votes").count().collect()}
    prior, chance = fit_accuracies(counts)
    bare = Model(prior, chance, np.zeros(1), None)
    known = {p: bare.posterior(p) for p in counts}
    session = docs.sparkSession
    label_of = session.createDataFrame(list(known.items()) or [("", prior)], "pattern string, label double")
    weak = cast.join(F.broadcast(label_of), F.col("votes") == F.col("pattern")).filter("votes <> ''")
    halves = chosen(weak.filter("label < 0.5"), train_rows // 2).unionByName(chosen(weak.filter("label >= 0.5"), train_rows // 2))
    quality = fit_scorer(with_text(docs, halves))
    toxicity = None
    if labels is not None:
        # Of several labels of one document the worse one holds.
        marked = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("double")).alias("label"))
        both = chosen(marked.filter("label > 0.5"), train_rows // 2).unionByName(chosen(marked.filter("label <= 0.5"), train_rows // 2))
        toxicity = fit_lexicon(with_text(docs, both))
    return Model(prior, chance, quality, toxicity)


def with_text(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The texts of a bounded sample of documents with their labels; of several texts or labels of one id the least."""
    one = sample.groupBy("doc_id").agg(F.min("label").alias("label"))
    return docs.select("doc_id", "text").join(F.broadcast(one), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def probability(weights: np.ndarray, at: np.ndarray) -> float:
    margin = weights[at].sum() / np.sqrt(len(at)) + weights[-1]
    return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of the documents with posterior, score, toxicity and keep, which replace columns of these names."""
    added = ("votes", "posterior", "score", "toxicity", "keep")
    names = [c for c in docs.columns if c not in added]
    kept = docs.select(*names)
    schema = T.StructType([*kept.schema.fields]).add("votes", "string").add("posterior", "double").add("score", "double").add("toxicity", "double").add("keep", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, posterior = WordFacts(), {}
        for batch in batches:
            votes, weak, score, toxic = [], [], [], []
            for text in base.texts(batch):
                read = read_text(text, known)
                pattern = votes_of(len(read[0]), read[2]) if read else ""
                if pattern not in posterior:
                    posterior[pattern] = model.posterior(pattern)
                hashes = word_hashes(read[1]) if read else None
                at = features_of(hashes, read[2]) if read else None
                votes.append(pattern)
                weak.append(posterior[pattern])
                score.append(1.0 if at is None else probability(model.quality, at))
                toxic.append(model.toxic(hashes) if read else 0.0)
            keep = [(s >= 0.5 or w >= 0.5) and t < TOXIC for s, w, t in zip(score, weak, toxic, strict=True)]
            columns = [*batch.columns, pa.array(votes, pa.string()), pa.array(weak), pa.array(score), pa.array(toxic), pa.array(keep, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    return kept.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model accepts, with their own columns."""
    names = [c for c in docs.columns if c not in ("votes", "posterior", "score", "toxicity", "keep")]
    return scores(docs, model).filter("keep").select(*names)
