"""Line dedup: repeated runs of lines, found by prefix doubling over line IDs.

A line's ID is a 128-bit hash. Doubling names runs of 1, 2, 4, ... lines that start at a line: a
run's name is made of the names of its halves. Suffixes that share a name form one interval of
the suffix array (a common prefix of that many lines); intervals of one suffix are left out of
all later rounds, so only text that does repeat is carried on. Names are hashes in place of
ranks, which saves the sort of each round.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import word_count
from tillroll.scratch import Scratch

# A run counts as repeated from this many words on, as one long line or many short ones.
MIN_WORDS = 50
# A shorter line counts as repeated if it is no shorter than this, and all its copies together
# have so many words: the fewer words it has, the more copies it takes.
SHORT_WORDS, SHORT_MASS = 5, 500

_NAME = ["a", "b"]


def _doc_key(doc_id: str) -> Column:
    """16 bytes for a document: its id and text, either of which may be null."""
    both = F.to_json(F.struct(F.col(doc_id).alias("id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text")))
    return F.substring(F.unhex(F.sha2(both, 256)), 1, 16)


def _lines(docs: DataFrame, doc_id: str) -> DataFrame:
    """One row per line: document, place, ID and number of words."""
    lines = F.transform(
        F.split(F.col("text"), "\n", -1),
        lambda x: F.struct(
            F.xxhash64(x).alias("a"),
            F.xxhash64(F.lit(1), x).alias("b"),
            word_count(x).cast("int").alias("w"),
        ),
    )
    # The key is made below the explosion: above it, it would be made again for every line.
    keyed = docs.filter("text is not null").select(F.col(doc_id).alias("id"), _doc_key(doc_id).alias("doc"), lines.alias("lines"))
    exploded = keyed.select("id", "doc", F.posexplode("lines").alias("pos", "line"))
    return exploded.select("id", "doc", "pos", "line.a", "line.b", "line.w")


def _repeated(suffixes: DataFrame) -> DataFrame:
    """Suffixes whose name occurs more than once."""
    names = suffixes.groupBy(*_NAME).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return suffixes.join(names, _NAME, "left_semi")


def _needed_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """The shortest runs of ``min_words`` words that start, and those that end, at each line.

    Only stretches of repeated lines are looked at. Any repeated run with enough words is the
    union of such runs. Within a stretch the other end is found by binary search in the running
    number of words.
    """
    place = Window.partitionBy("doc").orderBy("pos")
    stretch = F.col("pos") - F.row_number().over(place)
    upto = Window.partitionBy("doc", "stretch").orderBy("pos")
    counted = lines.withColumn("stretch", stretch).withColumn("c", F.sum("w").over(upto))
    arrays = (
        counted.groupBy("id", "doc", "stretch")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "c", "w"))).alias("x"))
        .filter(F.element_at("x", -1)["c"] >= min_words)
        .select(
            "id", "doc",
            F.col("x")[0]["pos"].alias("first"),
            F.col("x.c").alias("upto"),
            F.transform("x", lambda r: r["c"] - r["w"]).alias("before"),
            F.size("x").alias("n"),
        )
    )
    def search(found: str) -> str:
        """SQL for the first place in 0..n where ``found`` holds for ``mid``, or n."""
        mid = "cast((s.lo + s.hi) div 2 as int)"
        return f"""aggregate(sequence(0, cast(ceil(log2(n + 1)) as int)), named_struct('lo', 0, 'hi', n),
            (s, step) -> if(s.lo >= s.hi, s, if({found.replace("mid", mid)},
                named_struct('lo', s.lo, 'hi', {mid}), named_struct('lo', {mid} + 1, 'hi', s.hi))), s -> s.lo)"""

    # Ends are exclusive; a run that does not exist gets an empty one.
    ahead = search(f"upto[mid] >= before[i] + {min_words}")
    back = search(f"before[mid] > upto[i] - {min_words}")
    runs = F.expr(f"""flatten(transform(sequence(0, n - 1), i -> array(
        named_struct('ends', false, 'lo', i, 'hi', least(n, {ahead} + 1), 'fits', {ahead} < n),
        named_struct('ends', true, 'lo', {back} - 1, 'hi', i + 1, 'fits', {back} > 0))))""")
    return (
        arrays.select("id", "doc", "first", F.explode(F.filter(runs, lambda r: r["fits"])).alias("r"))
        .select("id", "doc", "r.ends", (F.col("first") + F.col("r.lo")).alias("pos"), (F.col("r.hi") - F.col("r.lo")).alias("m"))
        .distinct()
    )


def _place() -> Column:
    return F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("doc"), F.col("pos"))


def _frequent_lines(suffixes: DataFrame, min_words: int, short_words: int, short_mass: int) -> DataFrame:
    """(doc, pos, m) of later copies of short lines that occur often, counted by their names."""
    short = suffixes.filter((F.col("w") >= short_words) & (F.col("w") < min_words))
    names = short.groupBy(*_NAME, "w").agg(F.count(F.lit(1)).alias("n"), F.min(_place()).alias("first"))
    often = names.filter(F.col("n") * F.col("w") >= short_mass).select(*_NAME, "first")
    later = short.withColumn("place", _place()).join(often, _NAME).filter("place > first")
    return later.select("doc", "pos", F.lit(1).alias("m"))


def repeated_runs(
    docs: DataFrame,
    scratch: Scratch,
    doc_id: str = "doc_id",
    min_words: int = MIN_WORDS,
    short_words: int = SHORT_WORDS,
    short_mass: int = SHORT_MASS,
) -> DataFrame:
    """(doc, pos, m): runs of ``m`` lines from line ``pos`` that stand in an earlier place too.

    Places are ordered by ``doc_id`` (nulls last), then text hash, then line. Every line of every
    later copy of a run with ``min_words`` words or more is in one of these runs; so is every later
    copy of a shorter line of ``short_words`` or more whose copies have ``short_mass`` words in
    all; and no other.
    """
    lines = scratch.cut(_lines(docs, doc_id), "lines")
    # Repeated rows are one document.
    suffixes = scratch.cut(_repeated(lines).dropDuplicates(["doc", "pos"]), "suffixes")
    needed = scratch.cut(_needed_runs(suffixes, min_words), "needed")
    short = _frequent_lines(suffixes, min_words, short_words, short_mass)
    longest = needed.agg(F.max("m")).first()[0] or 0
    suffixes = suffixes.select("doc", "pos", *_NAME)
    named = []
    size = 1
    while size <= longest:
        # Runs of size .. 2 * size - 1 lines are two overlapping runs of ``size`` lines.
        due = needed.filter(F.col("m").between(size, 2 * size - 1))
        head = suffixes.select("doc", "pos", F.col("a").alias("a1"), F.col("b").alias("b1"))
        if size == 1:
            whole = due.join(head, ["doc", "pos"])
            whole = whole.withColumns({"a2": F.col("a1"), "b2": F.col("b1")})
        else:
            tail = suffixes.select("doc", F.col("pos").alias("tail"), F.col("a").alias("a2"), F.col("b").alias("b2"))
            whole = due.withColumn("tail", F.col("pos") + F.col("m") - size).join(head, ["doc", "pos"]).join(tail, ["doc", "tail"])
        named.append(whole.select("id", "doc", "ends", "pos", "m", "a1", "b1", "a2", "b2"))
        if 2 * size <= longest:
            behind = suffixes.select(
                "doc", (F.col("pos") - size).alias("pos"), F.col("a").alias("a2"), F.col("b").alias("b2")
            )
            doubled = suffixes.join(behind, ["doc", "pos"]).select(
                "doc", "pos", F.xxhash64("a", "a2", F.lit(2)).alias("a"), F.xxhash64("b", "b2", F.lit(3)).alias("b")
            )
            suffixes = scratch.cut(_repeated(doubled), f"doubled-{2 * size}")
        size *= 2
    if not named:
        return short
    runs = named[0]
    for more in named[1:]:
        runs = runs.unionByName(more)
    runs = scratch.cut(runs, "runs")
    name = ["ends", "m", "a1", "b1", "a2", "b2"]
    place = _place()
    first = runs.groupBy(*name).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    later = runs.withColumn("place", place).join(first, name).filter("place > first")
    return later.select("doc", "pos", "m").unionByName(short).distinct()


def dedup_lines(
    docs: DataFrame,
    scratch: Scratch,
    doc_id: str = "doc_id",
    min_words: int = MIN_WORDS,
    short_words: int = SHORT_WORDS,
    short_mass: int = SHORT_MASS,
) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``, and with n_lines
    and n_removed, replacing columns of these names.

    A run is consecutive whole lines (between newlines) with ``min_words`` words (between ASCII
    blanks) or more in sum; or one shorter line of ``short_words`` or more, if all its copies have
    ``short_mass`` words together. The first copy by ``doc_id``, nulls last, stays. Copies inside one
    document count, also overlapping ones. Rows equal in id and text are one document and lose
    the same lines. A null text stays null with no lines; an empty one has one empty line. All
    rows stay, even with nothing left of their text. A text takes time by its number of lines.
    """
    runs = repeated_runs(docs, scratch, doc_id, min_words, short_words, short_mass)
    places = runs.select("doc", F.explode(F.sequence("pos", F.col("pos") + F.col("m") - 1)).alias("pos"))
    gone = places.groupBy("doc").agg(F.array_sort(F.collect_set("pos")).alias("_gone"))
    gone = gone.withColumnRenamed("doc", "_doc")
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.select(*others, _doc_key(doc_id).alias("_doc")).join(gone, "_doc", "left")
    lines = F.split(F.col("text"), "\n", -1)

    def without(known: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(known) - 1), F.col("_gone"))
        return F.array_join(F.transform(places, lambda i: F.get(known, i)), "\n")

    # As the one element of an array, so that a text is split once.
    rest = F.element_at(F.transform(F.array(lines), without), 1)
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(rest)
    return rows.select(
        *(text.alias("text") if c == "text" else c for c in others),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_removed"),
    )


def line_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    kept = dedup_lines(docs, Scratch(spark))
    return kept.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


# Shortest runs from and to every line, by the running number of words; the first place of each.
LINE_DEDUP_SQL = r"""
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents
), numbered AS (
  SELECT doc_id, l, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM split
), counted AS (
  SELECT doc_id, pos, l, w, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS c
  FROM (SELECT doc_id, pos, l, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM numbered)
), runs AS (
  SELECT a.doc_id, a.pos AS lo, min(b.pos) AS hi, false AS ends
  FROM counted a JOIN counted b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.c >= a.c - a.w + 50
  GROUP BY ALL
  UNION ALL
  SELECT a.doc_id, max(b.pos), a.pos, true
  FROM counted a JOIN counted b ON a.doc_id = b.doc_id AND b.pos <= a.pos AND b.c - b.w <= a.c - 50
  GROUP BY ALL
), named AS (
  SELECT r.doc_id, lo, hi, ends, array_to_string(l[lo:hi], chr(10)) AS content
  FROM runs r JOIN split USING (doc_id)
), later AS (
  SELECT *, row_number() OVER (PARTITION BY ends, content ORDER BY doc_id, lo) AS nth FROM named
), short AS (
  SELECT doc_id, pos, w * count(*) OVER (PARTITION BY line) AS mass,
         row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth
  FROM (SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM numbered)
  WHERE w >= 5 AND w < 50
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS pos FROM later WHERE nth > 1
  UNION
  SELECT doc_id, pos FROM short WHERE nth > 1 AND mass >= 500
)
SELECT n.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n.pos) FILTER (g.pos IS NULL), '')) AS kept_sha256
FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.pos = g.pos
GROUP BY n.doc_id
"""
