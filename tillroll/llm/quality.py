"""Quality classifier: hierarchical empirical Bayes over documents, hosts and their paths.

A logistic model over hashed words and the shape of the text gives each document its evidence.
Hosts, and paths within hosts, have rates of their own: labels count fully, the model's view of
unlabelled documents a little. Rates of sparse sites shrink toward the level above, by as much
as the sites of that level differ beyond chance. A document's posterior is its own evidence
moved by what its path is known for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import TRAIN_CHARS, hash_sample
from tillroll.llm.decontaminate import _FOLD
from tillroll.llm.near_dup import _pieces, _word_hashes
from tillroll.scratch import Scratch

BUCKET_BITS = 18
STEPS = 12  # of each number on the shape of a text
SHAPES = 5 * STEPS
TARGETS = ("quality", "toxic")
# Training sample: so many documents of each combination of labels.
TRAIN_DOCS = 1_500
MIN_ODDS = 1.0
MIN_SIGNIFICANCE = 6.0  # log-odds times the root of the number of sampled documents
ROUNDS = 150
RATE, RIDGE, SMOOTHING = 0.3, 1e-4, 0.003
SOFT = 0.1  # weight of an unlabelled document in its site's rate
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 10_000.0

_UPPER = np.isin(np.arange(256), np.arange(0x41, 0x5B))
_DIGIT = np.isin(np.arange(256), np.arange(0x30, 0x3A))
_MARK = np.array([0x21 <= b <= 0x7E and not chr(b).isalnum() for b in range(256)])


@dataclass(frozen=True)
class QualityModel:
    words: np.ndarray  # (buckets, targets)
    shapes: np.ndarray  # (SHAPES, targets)
    bias: np.ndarray  # (targets)


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct words, and of what the text looks like, in steps."""
    text = text or b""
    parts = [_word_hashes(p.translate(_FOLD)) for p in _pieces(text)]
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    buckets = np.unique((hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    codes = np.frombuffer(text, np.uint8)
    size, words = max(len(codes), 1), max(len(hashes), 1)
    numbers = (
        _UPPER[codes].sum() / size,
        _DIGIT[codes].sum() / size,
        _MARK[codes].sum() / size,
        1 - len(buckets) / words,
        size / words / 40,
    )
    steps = [k * STEPS + min(int(x**0.5 * STEPS), STEPS - 1) for k, x in enumerate(numbers)]
    return buckets, np.array(steps, np.int64)


def _balanced(truth: np.ndarray) -> np.ndarray:
    """Weights that make both labels count the same, whatever their numbers in the sample."""
    share = truth.mean()
    return np.where(truth == 1, 0.5 / share, 0.5 / (1 - share))


def train(texts: list[bytes | None], labels: np.ndarray) -> QualityModel:
    """Logistic regression on features scaled by their log-odds between the labels.

    Features with small log-odds, or such as chance would explain, are left out, and the words of
    a text share a weight; else the sum over a long text would drown what does tell.
    """
    described = [features(t) for t in texts]
    model = QualityModel(
        np.zeros((1 << BUCKET_BITS, len(TARGETS)), np.float32), np.zeros((SHAPES, len(TARGETS)), np.float32), np.zeros(len(TARGETS))
    )
    if not texts:
        return model
    words = 1 << BUCKET_BITS
    all_columns = np.concatenate([np.concatenate([b, words + s]) for b, s in described])
    all_rows = np.repeat(np.arange(len(texts)), [len(b) + len(s) for b, s in described])
    often = np.bincount(all_columns, minlength=words + SHAPES)
    for target in range(len(TARGETS)):
        truth = labels[:, target]
        if truth.min() == truth.max():
            model.bias[target] = 6.0 if truth[0] else -6.0
            continue
        balance = _balanced(truth)
        total = balance[truth == 1].sum()
        yes = np.bincount(all_columns, (balance * truth)[all_rows], words + SHAPES) / total
        no = np.bincount(all_columns, (balance * (1 - truth))[all_rows], words + SHAPES) / total
        odds = np.log((yes + SMOOTHING) / (no + SMOOTHING))
        odds[(np.abs(odds) < MIN_ODDS) | (np.abs(odds) * often**0.5 < MIN_SIGNIFICANCE)] = 0.0
        used = odds[all_columns] != 0
        row, column = all_rows[used], all_columns[used]
        is_word = column < words
        share = np.where(is_word, 1 / np.sqrt(np.maximum(np.bincount(row, is_word, len(texts)), 1))[row], 1.0)
        weight, bias = np.zeros(words + SHAPES), 0.0
        moved, turned = np.full(words + SHAPES, 1e-6), 1e-6
        for _ in range(ROUNDS):
            logit = np.bincount(row, share * (weight * odds)[column], len(texts)) + bias
            error = balance * (truth - 1 / (1 + np.exp(-np.clip(logit, -30, 30)))) / len(texts)
            gradient = np.bincount(column, share * error[row], words + SHAPES) * odds - RIDGE * weight
            moved += gradient**2
            weight += RATE * gradient / np.sqrt(moved)
            turned += error.sum() ** 2
            bias += RATE * error.sum() / turned**0.5
        model.words[:, target], model.shapes[:, target] = np.split(weight * odds, [words])
        model.bias[target] = bias
    return model


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Train on at most ``TRAIN_DOCS`` labelled documents of each combination of labels."""
    hashed = F.xxhash64("doc_id")
    picked = {r["doc_id"]: r for r in hash_sample(labels, hashed, list(TARGETS), TRAIN_DOCS, 4).collect()}
    wanted = docs.select("doc_id", "text").filter(F.col("doc_id").isin(list(picked)))
    sample = [
        {**picked[r["doc_id"]].asDict(), "text": r["text"]}
        # Of several texts under one id, the first by text.
        for r in wanted.groupBy("doc_id").agg(F.min("text").alias("text")).select("doc_id", F.left("text", F.lit(TRAIN_CHARS)).alias("text")).orderBy("doc_id").collect()
    ]
    texts = [None if r["text"] is None else r["text"].encode("utf-8") for r in sample]
    return train(texts, np.array([[float(r[t]) for t in TARGETS] for r in sample]).reshape(-1, len(TARGETS)))


def _evidence(spark: SparkSession, model: QualityModel) -> Column:
    shared = spark.sparkContext.broadcast(model)  # buckets x targets

    @F.pandas_udf(T.StructType([T.StructField(t, T.DoubleType()) for t in TARGETS]))
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            out = np.zeros((len(batch), len(TARGETS)))
            for i, text in enumerate(batch):
                buckets, steps = features(text)
                words = known.words[buckets]
                out[i] = words.sum(0) / np.sqrt(np.maximum((words != 0).sum(0), 1)) + known.shapes[steps].sum(0) + known.bias
            yield pd.DataFrame(np.clip(out, -30, 30), columns=list(TARGETS))

    return judge.asNondeterministic()(F.col("text").cast("binary"))


def one_label(labels: DataFrame) -> DataFrame:
    """(doc_id, quality, toxic): one row for each document, by majority, ties to 1."""
    rows = labels.filter(" and ".join(f"{c} is not null" for c in ("doc_id", *TARGETS)))
    return rows.groupBy("doc_id").agg(*((F.avg(t) >= 0.5).cast("int").alias(t) for t in TARGETS))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.ln(p / (1 - p))


def _strength(sites: DataFrame, count: str, total: str, prior: Column) -> float:
    """Weight of the prior in documents, from how far the sites' rates lie apart.

    Beyond chance, rates vary by p (1 - p) / (strength + 1); what chance explains is taken off.
    """
    p = F.col(total) / F.col(count)
    chance = prior * (1 - prior)
    row = sites.filter(F.col(count) > 0).agg(
        F.sum(F.col(count) * (p - prior) ** 2).alias("spread"),
        F.sum(chance).alias("chance"),
        F.sum(F.col(count) * chance).alias("weighted"),
    ).first()
    excess = (row["spread"] or 0.0) - (row["chance"] or 0.0)
    if excess <= 0:
        return MOST_STRENGTH
    return float(np.clip((row["weighted"] or 0.0) / excess, LEAST_STRENGTH, MOST_STRENGTH))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    model: QualityModel,
    scratch: Scratch,
    host: str = "source",
    path: str = "lang",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, host, path, quality, toxic, kept and the columns ``keep``), one row per document.

    ``quality`` and ``toxic`` are posterior probabilities; ``kept`` is quality of 0.5 or more and
    toxicity below it. A labelled document's own label is left out of what its site says about
    it. Missing hosts and paths are sites of their own, as are empty ones; null texts are empty.
    Repeated rows are documents; labels without a document are ignored, and without any label
    the rates are the model's alone.
    """
    spark = docs.sparkSession
    judged = docs.select("doc_id", F.col(host).alias("host"), F.col(path).alias("path"), *keep, _evidence(spark, model).alias("e"))
    judged = judged.join(one_label(labels).withColumn("labelled", F.lit(1.0)), "doc_id", "left")
    weight = F.coalesce("labelled", F.lit(SOFT))
    rows = judged.select("doc_id", "host", "path", *keep, "e", weight.alias("w"), "labelled", *TARGETS)
    value = {t: F.coalesce(F.col(t).cast("double"), 1 / (1 + F.exp(-F.col(f"e.{t}")))) for t in TARGETS}
    rows = scratch.cut(rows.withColumns({f"v_{t}": v for t, v in value.items()}).drop(*TARGETS), "evidence")
    sums = [F.sum("w").alias("n"), *(F.sum(F.col("w") * F.col(f"v_{t}")).alias(f"s_{t}") for t in TARGETS)]
    paths = scratch.cut(rows.groupBy("host", "path").agg(*sums), "paths")
    upward = [F.sum("n").alias("n"), *(F.sum(f"s_{t}").alias(f"s_{t}") for t in TARGETS)]
    hosts = scratch.cut(paths.groupBy("host").agg(*upward), "hosts")
    world = hosts.agg(*upward).first()
    if not world["n"]:
        return rows.select(
            "doc_id", "host", "path", *(F.lit(0.0).alias(t) for t in TARGETS), F.lit(True).alias("kept"), *keep
        )
    rate = {t: (world[f"s_{t}"] + 0.5) / (world["n"] + 1) for t in TARGETS}
    of_host = {t: _strength(hosts, "n", f"s_{t}", F.lit(rate[t])) for t in TARGETS}
    renamed = hosts.select(F.col("host").alias("_host"), F.col("n").alias("hn"), *(F.col(f"s_{t}").alias(f"h_{t}") for t in TARGETS))
    sites = scratch.cut(paths.join(renamed, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"), "sites")

    def host_rate(t: str, n: Column | float = 0.0, s: Column | float = 0.0) -> Column:
        """The host's posterior without ``n`` documents of sum ``s``."""
        k = of_host[t]
        return (F.col(f"h_{t}") - s + k * rate[t]) / (F.col("hn") - n + k)

    of_path = {t: _strength(sites, "n", f"s_{t}", host_rate(t)) for t in TARGETS}
    sites = sites.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "n", "hn", *(f"{a}_{t}" for a in "sh" for t in TARGETS))
    placed = rows.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))

    def posterior(t: str) -> Column:
        own = F.col("w") * F.col(f"v_{t}")
        k = of_path[t]
        site = (F.col(f"s_{t}") - own + k * host_rate(t, F.col("w"), own)) / (F.col("n") - F.col("w") + k)
        return 1 / (1 + F.exp(-(F.col(f"e.{t}") + _logit(site) - _logit(F.lit(rate[t])))))

    out = placed.select("doc_id", "host", "path", *(posterior(t).alias(t) for t in TARGETS), *keep)
    return out.withColumn("kept", (F.col("quality") >= 0.5) & (F.col("toxic") < 0.5))


def quality_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scratch = Scratch(spark)
    model = fit(docs, one_label(labels))
    return classify(docs, labels, model, scratch).select("doc_id", "host", "path", "quality", "toxic", "kept")
