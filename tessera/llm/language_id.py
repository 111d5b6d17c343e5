"""Language identification by hierarchical discrimination.

Texts are bags of byte trigrams around letters, hashed into a fixed number of features. The
languages are first merged into families by the similarity of their mean profiles. A text's family
is predicted by one-against-the-rest linear support vector machines; within the family one-versus-
one machines between its closely related languages vote. Every labelled language is learned.
Training takes a bounded, hash-chosen sample of labelled texts: ``SAMPLE`` distinct texts dealt over
the languages, at most ``SAMPLE_PER_LANG`` and at least ``SAMPLE_FLOOR`` of each. The sample stays in
Spark as sparse rows: each machine is trained in a task of its own over the rows of its languages,
and only mean profiles and weights come to the driver. Feature counting and prediction run in Spark
over whole texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0. Without any labelled
row every text is ``und``. Rows with a null ``lang`` are predicted and not learned from; a row with
a null ``doc_id`` is not held out. Repeated rows are predicted one by one. Extra columns are
ignored by ``identify`` and carried through by ``drop_unidentified``, which drops what is ``und`` or
was told with a score below ``MIN_SCORE``: the score is the product of two sides' chances, family and
language, so a lower one says that both were told no better than by tossing a coin.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import staged

UNKNOWN = "und"
SAMPLE = 4000
SAMPLE_PER_LANG = 500
SAMPLE_FLOOR = 8
#: Languages of a family; pairs within families, and so the model, stay in proportion to languages.
FAMILY = 12
MIN_SCORE = 0.25
#: Up to so many languages their bounds are broadcast (a few MB); beyond, rows meet them by a shuffle.
BROADCAST_LANGS = 50_000
FEATURES = 1 << 13
_SLICE = 2_000_000

_LETTER = regex.compile(r"\p{L}")
_CLASS = np.full(256, 32, np.uint8)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def _counts(raw: list[bytes]) -> np.ndarray:
    """Relative frequencies of the hashed trigrams of each text (rows)."""
    data = _CLASS[np.frombuffer(b" " + b"  ".join(raw) + b" ", np.uint8)].astype(np.uint32)
    lens = np.fromiter((len(r) for r in raw), np.int64, len(raw))
    firsts = np.zeros(len(raw), np.int64)
    np.cumsum(lens[:-1] + 2, out=firsts[1:])
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    at = np.flatnonzero(data[1:-1] != 32)
    doc = np.searchsorted(firsts, at, side="right") - 1
    feature = (code[at] * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURES.bit_length() + 1)
    x = np.bincount(doc * FEATURES + feature, minlength=len(raw) * FEATURES).reshape(len(raw), FEATURES).astype(np.float32)
    return x / np.maximum(x.sum(1, keepdims=True), 1)


def _slices(texts: list[str]) -> Iterator[list[bytes]]:
    """Texts as bytes, in runs of up to 256 texts and about 2 MB."""
    run, size = [], 0
    for t in texts:
        b = t.encode("utf-8", "surrogatepass")
        if run and (len(run) == 256 or size + len(b) > _SLICE):
            yield run
            run, size = [], 0
        run.append(b)
        size += len(b)
    if run:
        yield run


def features(texts: list[str]) -> Iterator[np.ndarray]:
    for run in _slices(texts):
        yield _counts(run)


# --- training ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """Linear machines on the features: one per family, then one per pair within a family."""

    families: list[list[str]]
    weights: np.ndarray  # features x machines
    bias: np.ndarray
    pairs: list[tuple[int, int, int]]  # family, first, second (places in the family)


@dataclass(frozen=True)
class Sparse:
    """Rows of relative frequencies: the entries of row i are ``start[i]:start[i + 1]``."""

    start: np.ndarray
    place: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, places: list[np.ndarray], values: list[np.ndarray]) -> Sparse:
        start = np.zeros(len(places) + 1, np.int64)
        np.cumsum([len(p) for p in places], out=start[1:])
        return cls(start, np.concatenate([*places, np.zeros(0, np.uint16)]).astype(np.int64),
                   np.concatenate([*values, np.zeros(0, np.float32)]).astype(np.float64))

    def times(self, w: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(self.value) + 1)
        np.cumsum(self.value * w[self.place], out=sums[1:])
        return sums[self.start[1:]] - sums[self.start[:-1]]

    def combined(self, weight: np.ndarray) -> np.ndarray:
        """The sum of the rows, each times its weight."""
        return np.bincount(self.place, self.value * np.repeat(weight, np.diff(self.start)), FEATURES)

    def scaled(self, scale: np.ndarray) -> Sparse:
        return Sparse(self.start, self.place, self.value * scale[self.place])


def _svm(x: Sparse, y: np.ndarray, rounds: int = 200, c: float = 30.0) -> tuple[np.ndarray, float]:
    """L2-regularised squared-hinge machine by accelerated gradient steps; classes weigh alike."""
    w, b = np.zeros(FEATURES), 0.0
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    norms = Sparse(x.start, x.place, x.value**2).times(np.ones(FEATURES))
    step = 1.0 / (1.0 / c + 2 * float((weight * (norms + 1)).sum()))
    vw, vb, t = w, b, 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x.times(vw) + vb)) * weight * y
        nw = vw - step * (vw / c - 2 * x.combined(slack))
        nb = vb + step * 2 * float(slack.sum())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


def language_families(names: list[str], profiles: np.ndarray) -> list[list[str]]:
    """Average-link merging of the languages while the closest two groups are more similar than
    two languages are on average, into families of at most ``FAMILY``; two languages or fewer are
    one family."""
    if len(names) <= 2:
        return [names] if names else []
    unit = profiles / np.maximum(np.linalg.norm(profiles, axis=1, keepdims=True), 1e-9)
    sim = unit @ unit.T
    mean = (sim.sum() - len(names)) / (len(names) * (len(names) - 1))
    groups, sums = [[i] for i in range(len(names))], sim.copy()  # sums of similarities between groups
    np.fill_diagonal(sums, -np.inf)
    while len(groups) > 1:
        size = np.array([len(g) for g in groups], float)
        link = np.where(size[:, None] + size > FAMILY, -np.inf, sums / np.outer(size, size))
        a, b = sorted(np.unravel_index(int(link.argmax()), link.shape))
        if link[a, b] <= mean:
            break
        sums[a], sums[:, a] = sums[a] + sums[b], sums[:, a] + sums[:, b]
        sums[a, a] = -np.inf
        sums = np.delete(np.delete(sums, b, 0), b, 1)
        groups[a] += groups.pop(b)
    return [[names[i] for i in sorted(g)] for g in groups]


def machines_of(families: list[list[str]]) -> list[tuple[int, int, int]]:
    """The machines of a model as (family, first, second): a family against the rest has -1, -1."""
    out = [(i, -1, -1) for i in range(len(families))] if len(families) > 1 else []
    return out + [(i, a, b) for i, f in enumerate(families) for a in range(len(f)) for b in range(a + 1, len(f))]


def assemble(families: list[list[str]], machines: list[tuple[int, int, int]], weights: dict[int, tuple[np.ndarray, float]]) -> Model:
    columns = [weights[i] for i in range(len(machines))]
    if len(families) == 1:  # the one family is always told
        columns.insert(0, (np.zeros(FEATURES), 1.0))
    return Model(families, np.stack([w for w, _ in columns], 1).astype(np.float32), np.array([b for _, b in columns], np.float32),
                 [m for m in machines if m[1] >= 0])


def scale_of(n: int, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """What evens out the features' spread; it is folded into the weights, so prediction sees plain
    frequencies."""
    return 1 / (np.sqrt(np.maximum(squares / n - (total / n) ** 2, 0)) + 1e-4)


def signs(machine: tuple[int, int, int], families: list[list[str]], langs: np.ndarray) -> np.ndarray:
    """+1 and -1 for the rows on either side of a machine, 0 for the others."""
    family, a, b = machine
    members = families[family]
    if a < 0:
        return np.where(np.isin(langs, members), 1, -1)
    return (langs == members[a]).astype(int) - (langs == members[b])


def train(langs: np.ndarray, x: np.ndarray) -> Model | None:
    """A model of dense rows in one place; ``fit`` does the same with the rows in Spark."""
    if not len(langs):
        return None
    names = sorted(set(langs))
    scale = scale_of(len(x), x.sum(0), (x.astype(np.float64) ** 2).sum(0))
    families = language_families(names, np.stack([x[langs == n].mean(0) for n in names]))
    machines, weights = machines_of(families), {}
    for i, machine in enumerate(machines):
        y = signs(machine, families, langs)
        rows = [np.flatnonzero(r) for r in x[y != 0]]
        w, bias = _svm(Sparse.of(rows, [r[p] for r, p in zip(x[y != 0], rows)]).scaled(scale), y[y != 0])
        weights[i] = w * scale, bias
    return assemble(families, machines, weights)


def predict(model: Model | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    known = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)] if model else []
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    at = 0
    within_family: dict[int, list[tuple[int, int, int]]] = {}
    for k, (f, a, b) in enumerate(model.pairs if model else ()):
        within_family.setdefault(f, []).append((k, a, b))
    for x in features([texts[i] for i in known]):
        margin = x @ model.weights + model.bias
        n_fam = len(model.families)
        fam = margin[:, :n_fam]
        best = fam.argmax(1)
        rest = np.where(np.arange(n_fam) == best[:, None], -np.inf, fam).max(1) if n_fam > 1 else best - np.inf
        sure = 1 / (1 + np.exp(-2 * np.clip(fam.max(1) - rest, 0, 20)))
        for r in range(len(x)):
            members = model.families[best[r]]
            votes, strength = np.zeros(len(members)), np.zeros(len(members))
            for k, a, b in within_family.get(int(best[r]), ()):
                m = float(margin[r, n_fam + k])
                votes[a if m > 0 else b] += 1
                strength[a] += m
                strength[b] -= m
            win = max(range(len(members)), key=lambda i: (votes[i], strength[i]))
            within = 1 / (1 + np.exp(-2 * np.clip(strength[win] / max(1, len(members) - 1), -20, 20))) if len(members) > 1 else 1
            langs[known[at + r]], scores[known[at + r]] = members[win], float(sure[r] * within)
        at += len(x)
    return langs, scores


_ROW = "lang string, places binary, values binary"


def _sparse(pdf: pd.DataFrame) -> Sparse:
    return Sparse.of([np.frombuffer(p, np.uint16) for p in pdf["places"]], [np.frombuffer(v, np.float32) for v in pdf["values"]])


def sample_rows(labelled: DataFrame, sample: int, per_lang: int, floor: int) -> DataFrame:
    """(``lang``, ``text``): a language's size is its number of distinct texts with a letter; a hash of
    the text chooses its share of ``sample``, at least the text of the smallest hash, so a retry
    chooses the same, copies count once and no language is without a sample."""
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").filter(F.col("text").rlike(r"\p{L}")) \
        .select("lang", "text", F.xxhash64("text").alias("h")).withColumn("key", F.pmod("h", F.lit(1 << 40)))
    sizes = staged(rows.sparkSession, rows.select("lang", "h", "key").distinct().groupBy("lang").agg(
        F.count("*").alias("n"), F.min("key").alias("least")), "languages")
    langs = sizes.count()
    wanted = max(floor, min(per_lang, sample // max(1, langs)))
    bound = sizes.select("lang", F.greatest(F.col("least") + 1, F.floor(F.least(F.lit(1.0), F.lit(wanted) / F.col("n")) * F.lit(1 << 40)))
                         .alias("bound"))
    if langs <= BROADCAST_LANGS:
        bound = F.broadcast(bound)
    return rows.join(bound, "lang").filter("key < bound").dropDuplicates(["lang", "h"]).select("lang", "text")


def fit(spark: SparkSession, labelled: DataFrame, sample: int = SAMPLE, per_lang: int = SAMPLE_PER_LANG,
        floor: int = SAMPLE_FLOOR) -> Model | None:
    """Train on rows (``text``, ``lang``). The driver sees one mean profile per language, from which
    it forms the families, and the weights of the machines."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf, at = pdf[[bool(_LETTER.search(t)) for t in pdf["text"]]], 0
            for x in features(list(pdf["text"])):
                places = [np.flatnonzero(r).astype(np.uint16) for r in x]
                yield pd.DataFrame({"lang": pdf["lang"].iloc[at:at + len(x)].to_list(), "places": [p.tobytes() for p in places],
                                    "values": [r[p].tobytes() for r, p in zip(x, places)]})
                at += len(x)

    rows = staged(spark, sample_rows(labelled, sample, per_lang, floor).mapInPandas(count, _ROW), "language-sample")

    def profile(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x, one = _sparse(pdf.sort_values(["places", "values"])), np.ones(len(pdf))
        squares = Sparse(x.start, x.place, x.value**2)
        return pd.DataFrame({"lang": [key[0]], "n": [len(pdf)], "total": [x.combined(one).tobytes()], "squares": [squares.combined(one).tobytes()]})

    got = sorted(rows.groupBy("lang").applyInPandas(profile, "lang string, n long, total binary, squares binary").collect())
    if not got:
        return None
    names, n = [r["lang"] for r in got], np.array([r["n"] for r in got])
    totals, squares = (np.stack([np.frombuffer(r[c], np.float64) for r in got]) for c in ("total", "squares"))
    scale = scale_of(int(n.sum()), totals.sum(0), squares.sum(0))
    families = language_families(names, totals / n[:, None])
    machines = machines_of(families)
    sides = [(name, i, int(s)) for i, m in enumerate(machines) for name, s in zip(names, signs(m, families, np.array(names, object))) if s]

    def machine(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["lang", "places", "values"])
        w, b = _svm(_sparse(pdf).scaled(scale), pdf["side"].to_numpy())
        return pd.DataFrame({"machine": [key[0]], "weights": [(w * scale).astype(np.float32).tobytes()], "bias": [b]})

    weights = {}
    if sides:
        dealt = rows.join(spark.createDataFrame(sides, "lang string, machine int, side int"), "lang")
        # as many partitions as machines, up to a bound: a machine is a task
        dealt = dealt.repartition(min(len(machines), 1000), "machine")
        for r in dealt.groupBy("machine").applyInPandas(machine, "machine int, weights binary, bias double").collect():
            weights[r["machine"]] = np.frombuffer(r["weights"], np.float32), r["bias"]
    return assemble(families, machines, weights)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _fitted(spark: SparkSession, docs: DataFrame):
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))
    return spark.sparkContext.broadcast(fit(spark, plain.filter(~held_out(F.col("doc_id"))).select("text", "lang")))


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``; a quarter of the
    ids is held out of training."""
    model = _fitted(spark, docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = predict(model.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def drop_unidentified(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Pipeline form, columns as given: documents go whose language cannot be told (``und``), or is
    told with a score below ``MIN_SCORE``."""
    model = _fitted(spark, docs)

    @F.pandas_udf("boolean")
    def told(text: pd.Series) -> pd.Series:
        langs, scores = predict(model.value, [None if t is None else t for t in text])
        return pd.Series([lang != UNKNOWN and score >= MIN_SCORE for lang, score in zip(langs, scores)])

    return docs.filter(told(F.col("text").cast("string")))
