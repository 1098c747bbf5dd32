"""URL filter: rules for hosts and paths, and a logistic regression for what no rule decides.

The regression sees the character n-grams of host and path, hashed to a fixed number of features, and is
trained on a small table of labelled URLs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudtide.llm.labelled_urls import LABELLED

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """Decides for ``host``, its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules that the query asks for.
RULES = (
    Rule("allow", "org"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


@dataclass(frozen=True)
class Filter:
    """``sizes`` of the n-grams, hashed to 2^``bits`` features. At most ``labelled`` rows are trained on, the
    first by hash. ``block``: the probability from which on a URL is blocked."""

    rules: Sequence[Rule] = RULES
    sizes: tuple[int, ...] = (2, 3, 4)
    bits: int = 16
    labelled: int = 20_000
    penalty: float = 1e-4
    block: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What lies between the first ``://`` and the next ``/``, ``?``, ``#`` or end, and from there to ``?``,
    ``#`` or the end; both empty without a ``://`` or a URL. A-Z are lower-cased in the host."""
    host, path = (F.coalesce(F.regexp_extract(url, PARTS, i), F.lit("")) for i in (1, 2))
    return F.translate(host, UPPER, LOWER), path


@dataclass(frozen=True)
class RuleBook:
    """Rules by host. A URL looks up as many endings of its host as the longest rule has labels."""

    by_host: dict[str, list[Rule]] = field(default_factory=dict)
    labels: int = 0

    @staticmethod
    def of(rules: Sequence[Rule]) -> RuleBook:
        by_host: dict[str, list[Rule]] = {}
        for rule in sorted(rules, key=lambda r: (-len(r.name), r.name, r.verdict)):
            by_host.setdefault(rule.host, []).append(rule)
        return RuleBook(by_host, max((h.count(".") + 1 for h in by_host), default=0))

    def fitting(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits; of equally long ones the first by name."""
        labels = host.rsplit(".", self.labels)
        ends = [host] + [".".join(labels[i:]) for i in range(1, len(labels))]
        found = [r for end in ends for r in self.by_host.get(end, ()) if path.startswith(r.path)]
        return min(found, key=lambda r: (-len(r.name), r.name, r.verdict), default=None)


def n_grams(texts: list[str], size: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """For every n-gram of every text, with its ends marked: which text it is in, and its hash. All digits
    are alike."""
    marked = [f"\x02{t}\x03" for t in texts]
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    code[(code >= ord("0")) & (code <= ord("9"))] = ord("0")
    lengths = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    ends = np.repeat(np.cumsum(lengths), lengths)
    at = np.nonzero(np.arange(len(code)) + size <= ends)[0]
    hashed = reduce(lambda h, i: (h ^ code[at + i]) * MIX, range(size), np.full(len(at), salt, dtype=np.uint64))
    return np.repeat(np.arange(len(texts)), lengths)[at], hashed ^ (hashed >> np.uint64(29))


def features(hosts: list[str], paths: list[str], rules: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, features and values of the different n-grams; those of a host, and of a path, have length 1."""
    parts = []
    for place, texts in enumerate((hosts, paths)):
        for size in rules.sizes:
            row, hashed = n_grams(texts, size, 2 * size + place)
            key = np.unique(row.astype(np.uint64) << np.uint64(rules.bits) | (hashed * MIX) >> np.uint64(64 - rules.bits))
            parts.append((place, key))
    rows, ids, values = [], [], []
    for place in (0, 1):
        key = np.unique(np.concatenate([k for p, k in parts if p == place]))
        row = (key >> np.uint64(rules.bits)).astype(np.int64)
        rows.append(row)
        ids.append((key & np.uint64((1 << rules.bits) - 1)).astype(np.int64))
        values.append(1 / np.sqrt(np.bincount(row, minlength=len(hosts))[row]))
    return np.concatenate(rows), np.concatenate(ids), np.concatenate(values)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float

    def block(self, hosts: list[str], paths: list[str], rules: Filter) -> np.ndarray:
        """The probability that each URL is to be blocked."""
        row, feature, value = features(hosts, paths, rules)
        score = np.bincount(row, self.weights[feature] * value, minlength=len(hosts))
        return 1 / (1 + np.exp(-(score + self.intercept)))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table that comes with the filter: ``url, label``, 1 for URLs to be blocked."""
    return spark.createDataFrame(LABELLED, "url string, label int")


def trained(labelled: DataFrame, rules: Filter = Filter()) -> Model:
    """A model of ``url, label`` (0 or 1). Rows with nulls are left out, repeated ones count once; a table of
    one label, or none, gives a model that always says so, or allow."""
    host, path = host_and_path(labelled["url"])
    rows = labelled.where("url IS NOT NULL AND label IS NOT NULL")
    rows = rows.select(host.alias("host"), path.alias("path"), labelled["label"].cast("double").alias("label")).distinct()
    order = F.xxhash64("host", "path"), "host", "path", "label"
    taken = rows.orderBy(*order).limit(rules.labelled).toArrow().to_pydict()
    label = taken["label"]
    if len(set(label)) < 2:
        return Model(np.zeros(1 << rules.bits), 50.0 if 1.0 in label else -50.0)
    row, feature, value = features(taken["host"], taken["path"], rules)
    size = 1 << rules.bits
    known: dict[int, dict[int, float]] = {i: {} for i in range(len(label))}
    for i, j, x in zip(row.tolist(), feature.tolist(), value.tolist(), strict=True):
        known[i][j] = known[i].get(j, 0.0) + x
    vectors = [(label[i], Vectors.sparse(size, known[i])) for i in known]
    table = labelled.sparkSession.createDataFrame(vectors, ["label", "features"]).coalesce(1)
    model = LogisticRegression(regParam=rules.penalty, maxIter=60, tol=1e-6, standardization=False).fit(table)
    return Model(model.coefficients.toArray(), model.intercept)


OUT = "host string, path string, rule string, verdict string, score double"


def verdicts(pages: DataFrame, labelled: DataFrame | None = None, rules: Filter = Filter()) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row of ``page_id, url``.

    ``rule`` names the longest rule that fits, which then decides; the others go by the model's probability
    ``score``. A null or empty URL, or one without ``://``, has an empty host and path, no rule and the
    score of no n-grams. Repeated rows and null ids stay; other columns are left out; an empty table
    gives none. URLs may be of any length; one pass, nothing is shuffled. The rules and 2^bits weights
    are sent to every task.
    """
    spark = pages.sparkSession
    model = trained(labelled_urls(spark) if labelled is None else labelled, rules)
    known = spark.sparkContext.broadcast((model, RuleBook.of(rules.rules)))
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, book = known.value
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            score = model.block(hosts, paths, rules)
            found = list(map(book.fitting, hosts, paths))
            said = ["block" if s >= rules.block else "allow" for s in score]
            verdict = [r.verdict if r else s for r, s in zip(found, said, strict=True)]
            names = pa.array([r.name if r else None for r in found], pa.string())
            arrays = [*batch.columns, names, pa.array(verdict, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "host", "path", "rule", "verdict", "score"])

    host, path = host_and_path(pages["url"])
    return pages.select("page_id", host.alias("host"), path.alias("path")).mapInArrow(run, f"page_id {kind}, {OUT}")
