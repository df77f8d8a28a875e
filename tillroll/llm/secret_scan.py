"""Secret scans: fixed patterns, and two character Markov models that tell random strings from
ordinary identifiers by the logarithm of their likelihood ratio.

DataFrame functions only. A pattern's places come from the pieces between its matches: the
lengths of pieces and matches, summed up, are the positions in code points.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import hash_sample

# Kinds in the order they are listed, their patterns, and what a match must have.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")
MIN_ASSIGN_VALUE, MIN_ACCESS = 6, 20

MARKOV = "markov"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
CANDIDATE = r"[A-Za-z0-9+/=_-]{16,}"
WORD = r"[A-Za-z_]{6,}"

# Training samples: at most so many strings of each sort, the words from so many documents.
TRAIN_STRINGS = 20_000
TRAIN_DOCS = 2_000
SMOOTHING = 0.5
# Numbers summed as one run.
RUN_BITS = 8
# A candidate is a secret if each step is this much likelier in a random string, on average.
MIN_RATIO = 0.5


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda s, x: s + x)


def _before(numbers: Column) -> Column:
    """The sum of all numbers before each one. Sums of runs first, so that a long array takes
    little more than the time of its length."""
    low = F.lit((1 << RUN_BITS) - 1)

    def of(known: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(known) - 1, F.lit(0)), F.lit(1 << RUN_BITS))
        runs = F.transform(starts, lambda i: _sum(F.slice(known, i + 1, 1 << RUN_BITS)))
        return _let(runs, lambda sums: _let(of_runs(sums), lambda heads: each(known, heads)))

    def of_runs(sums: Column) -> Column:
        return F.transform(sums, lambda _, j: _sum(F.slice(sums, 1, j)))

    def each(known: Column, heads: Column) -> Column:
        first = lambda i: F.shiftleft(F.shiftright(i, RUN_BITS), RUN_BITS) + 1
        return F.transform(
            known,
            lambda _, i: F.element_at(heads, F.shiftright(i, RUN_BITS) + 1) + _sum(F.slice(known, first(i), i.bitwiseAND(low))),
        )

    return _let(numbers, of)


def _matches(text: Column, pattern: str) -> Column:
    """(start, end, match) of all leftmost matches that do not overlap, in order."""
    span = "struct<start:int,end:int,match:string>"

    def parts(found: Column) -> Column:
        """Each match with the length of the piece before it."""
        pieces = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        return F.zip_with(found, pieces, lambda m, p: F.struct(F.length(p).alias("before"), F.length(m).alias("size"), m.alias("match")))

    def placed(known: Column) -> Column:
        at = _before(F.transform(known, lambda x: x["before"] + x["size"]))
        return F.zip_with(
            known,
            at,
            lambda x, a: F.struct(
                (a + x["before"]).alias("start"), (a + x["before"] + x["size"]).alias("end"), x["match"].alias("match")
            ),
        )

    # Texts without a match are not split.
    spans = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: _let(parts(found), placed))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{span}>"))


def _overlaps(spans: Column, m: Column) -> Column:
    """Whether one of some spans, in order and apart from each other, overlaps another: by binary
    search for the last one that starts before its end."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(spans) + 1)).cast("int") + 1)
    whole = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state["low"] + state["high"] + 1, 1)
        before = F.coalesce(F.get(spans, middle - 1)["start"] < m["end"], F.lit(False))
        open_ = state["low"] < state["high"]
        return F.struct(
            F.when(open_ & before, middle).otherwise(state["low"]).alias("low"),
            F.when(open_ & ~before, middle - 1).otherwise(state["high"]).alias("high"),
        )

    last = F.aggregate(steps, whole, halve, lambda s: s["low"])
    return F.coalesce(F.get(spans, last - 1)["end"] > m["start"], F.lit(False))


def _letters(string: Column) -> Column:
    """The characters of a text, split once."""
    return F.filter(F.split(string, ""), lambda c: c != "")


def _assigned(match: Column) -> Column:
    """The value of an assignment, matched again by itself."""
    return F.regexp_extract(match, ASSIGN, 2)


def _base(text: Column) -> dict[str, Column]:
    return {
        "assign": F.filter(_matches(text, ASSIGN), lambda m: F.length(_assigned(m["match"])) >= MIN_ASSIGN_VALUE),
        "access": F.filter(_matches(text, ACCESS), lambda m: F.length(m["match"]) >= MIN_ACCESS),
        "hex": _matches(text, HEX),
    }


def _transitions(strings: DataFrame) -> dict[tuple[int, int], int]:
    """How often each character follows each other one; bounded by the alphabet."""
    def steps(letters: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(letters) - 1),
            lambda i: F.struct(F.element_at(letters, i).alias("a"), F.element_at(letters, i + 1).alias("b")),
        )

    pairs = strings.filter(F.length("s") > 1).select(F.explode(_let(_letters(F.col("s")), steps)).alias("p"))
    code = lambda c: F.instr(F.lit(ALPHABET), F.col(c))
    counts = pairs.select(code("p.a").alias("a"), code("p.b").alias("b")).filter("a > 0 and b > 0").groupBy("a", "b").count()
    return {(r["a"], r["b"]): r["count"] for r in counts.collect()}


def log_ratios(random: dict, ordinary: dict) -> list[float]:
    """Log-likelihood ratio of every step, rows by the first character; smoothed."""
    size = len(ALPHABET)

    def logs(counts: dict) -> list[float]:
        out = []
        for a in range(1, size + 1):
            total = sum(counts.get((a, b), 0) for b in range(1, size + 1)) + SMOOTHING * size
            out += [math.log((counts.get((a, b), 0) + SMOOTHING) / total) for b in range(1, size + 1)]
        return out

    return [r - o for r, o in zip(logs(random), logs(ordinary), strict=True)]


def fit(docs: DataFrame) -> list[float] | None:
    """The model, from labelled samples: what the base patterns find is random, words of letters
    are ordinary. None if there is nothing to learn from."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # A cheap test first; only texts with some match are split.
    likely = docs.filter(text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX)).select(text.alias("text"))
    values = F.concat(
        F.transform(F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= MIN_ASSIGN_VALUE), lambda v: v),
        F.filter(F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), lambda v: F.length(v) >= MIN_ACCESS),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )

    def sample(strings: DataFrame) -> DataFrame:
        return strings.distinct().orderBy(F.xxhash64("s"), "s").limit(TRAIN_STRINGS)

    random = _transitions(sample(likely.select(F.explode(values).alias("s"))))
    few = hash_sample(docs.filter("text is not null").select("text"), F.xxhash64("text"), [], TRAIN_DOCS, 1)
    words = few.select(F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("s"))
    ordinary = _transitions(sample(words))
    return log_ratios(random, ordinary) if random and ordinary else None


def _mean_ratio(string: Column, model: Column) -> Column:
    size = len(ALPHABET)
    codes = F.transform(_letters(string), lambda c: F.instr(F.lit(ALPHABET), c))

    def total(known: Column) -> Column:
        step = lambda i: (F.element_at(known, i) - 1) * size + F.element_at(known, i + 1)
        return F.aggregate(F.sequence(F.lit(1), F.size(known) - 1), F.lit(0.0), lambda s, i: s + F.element_at(model, step(i)))

    return _let(codes, total) / (F.length(string) - 1)


def _listed(kind: str, nth: int) -> Column:
    """A kind's spans, to be sorted by start and then by the kind's place in the list."""
    return F.transform(
        F.col(f"_{kind}"),
        lambda m: F.struct(m["start"].alias("start"), F.lit(nth).alias("nth"), m["end"].alias("end"), F.lit(kind).alias("kind")),
    )


def scan(docs: DataFrame, model: list[float] | None, text: str = "text") -> DataFrame:
    """``docs`` with secrets, an array of (kind, start, end) by start, then kind as listed,
    replacing a column of that name.

    Positions are code points, ends exclusive; matches of one kind do not overlap. A markov span
    is a run of 16 or more characters of the alphabet, not of digits alone, that overlaps no base
    span and whose steps are likelier in a random string. A null text is empty and has none. Long
    texts, runs and lists of matches take little more than the time of their length.
    Rows are judged by their text alone, so nulls and repeats elsewhere make no difference.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = _base(whole)
    found = docs.withColumns({f"_{kind}": spans for kind, spans in base.items()})
    if model is None:
        found = found.withColumn(f"_{MARKOV}", F.slice("_hex", 1, 0))
    else:
        ratios = F.array(*(F.lit(x) for x in model))
        found = found.withColumn("_model", ratios).withColumn("_candidates", _matches(whole, CANDIDATE))
        secret = F.filter(
            "_candidates",
            lambda m: ~_overlaps(F.col("_assign"), m)
            & ~_overlaps(F.col("_access"), m)
            & ~_overlaps(F.col("_hex"), m)
            & ~m["match"].rlike("^[0-9]+$")
            & (_mean_ratio(m["match"], F.col("_model")) >= MIN_RATIO),
        )
        found = found.withColumn(f"_{MARKOV}", secret).drop("_model", "_candidates")
    kinds = [*BASE_KINDS, MARKOV]
    spans = F.concat(*(_listed(kind, nth) for nth, kind in enumerate(kinds)))
    ordered = F.transform(F.array_sort(spans), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.withColumn("secrets", ordered).drop(*(f"_{kind}" for kind in kinds))


def redact(docs: DataFrame, model: list[float] | None, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask``; overlapping spans go together."""
    found = scan(docs, model, text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        before = F.substring(F.col(text), state["at"] + 1, s["start"] - state["at"])
        apart = s["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(state["out"], before, F.lit(mask))).otherwise(state["out"]).alias("out"),
        )

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(F.col(text), state["at"] + 1, F.length(text)))

    return found.withColumn(text, F.when(F.size("secrets") > 0, F.aggregate("secrets", start, step, finish)).otherwise(F.col(text)))


def secret_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = scan(docs, fit(docs))
    named = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("secrets", lambda s: s["kind"] != MARKOV)
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in (*BASE_KINDS, MARKOV)),
        F.sha2(named(base), 256).alias("base_sha256"),
        named(F.col("secrets")).alias("spans"),
    )
