"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions.

The mix is a sequence of slots. The golden-ratio sequence gives slot t a point, and the
cumulative target words map the point to a source, so that every stretch of the schedule holds
the sources in proportion. The slots of a source are ranked, and the r-th takes the r-th block
of that source: its documents in hash order, one pass after the other, cut into blocks of
equally many words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import BLANKS, packed, sum_before, unpacked
from terrane.operators.numbering import number_rows
from terrane.session import written

# Fixed values of the contract: weights by rank of the source, size of the mix against the
# input, and how often a source may be repeated.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
#: Words of a slot, or fewer so that a small mix has this many slots.
SLOT_WORDS, LEAST_SLOTS = 256, 4096
#: The golden ratio's fraction of the period; odd, so the sequence meets every point.
STEP, PERIOD = 1327217885, 1 << 31
CELLS = 4096
#: Rows of a hash bucket, in which documents are put in order, on average.
BUCKET_ROWS = 1000


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null has none."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "x")
    return F.coalesce(F.length(F.translate(marks, BLANKS, "")), F.lit(0)).cast("long")


def _digits(rows: int) -> int:
    """Hex digits whose buckets hold ``BUCKET_ROWS`` rows on average."""
    digits = 1
    while rows > BUCKET_ROWS * 16 ** digits:
        digits += 1
    return digits


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key, text_key) of every row, written once."""
    return written(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_key")), "sized")


def targets(rows: DataFrame) -> DataFrame:
    """(source, source_size, target, words, low): words to take of each source, and the words
    of all sources before it.

    Sources are sorted by range over tasks and ranked by task counts. The common level of
    target per weight follows by resharing: sources that reach their limit are set to it and
    the rest is shared anew, until no more do. Each round is one aggregate of two numbers.
    """
    order = F.asc_nulls_last("source")
    spark = rows.sparkSession
    part = (
        rows.groupBy("source").agg(F.sum("size").alias("source_size"))
        .repartitionByRange(order).withColumn("part", F.spark_partition_id())
        .withColumn("one", F.lit(1)).withColumn("all", F.lit(0)))
    ranked = sum_before(written(part, "sources"), ["all"], "part", [order], "one", "rank")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % 3 + 1).cast("int"))
    weighed = written(
        ranked.select("source", "source_size", "part", "all", "rank", weight.alias("weight"),
                      (F.col("source_size") * PASSES).alias("limit")), "weights")
    whole = weighed.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    total = SHARE * (whole["n"] or 0)
    level, found = None, total / (whole["w"] or 1)
    while found != level:
        level = found
        over = F.col("limit") <= F.col("weight") * F.lit(level)
        left = weighed.agg(F.sum(F.when(over, F.col("limit"))).alias("set"),
                           F.sum(F.when(~over, F.col("weight"))).alias("w")).first()
        if left["w"]:
            found = (total - (left["set"] or 0)) / left["w"]
    target = F.least(F.col("limit").cast("double"), F.col("weight") * F.lit(float(level)))
    with_words = weighed.withColumn("target", target).withColumn(
        "words", F.round("target").cast("long"))
    return written(
        sum_before(with_words, ["all"], "part", [F.asc("rank")], "words", "low")
        .select("source", "rank", "source_size", "target", "words", "low"), "targets")


def slots(goal: DataFrame) -> DataFrame:
    """(slot, rank, block): the schedule. A source that no point meets gets one slot
    after the others."""
    spark = goal.sparkSession
    whole = goal.agg(F.sum("words")).first()[0] or 0
    words = max(1, min(SLOT_WORDS, whole // LEAST_SLOTS))
    n = -(-whole // words)
    point = (F.col("id") * STEP) % PERIOD if n < PERIOD else (
        (F.col("id") % PERIOD) * STEP) % PERIOD
    place = F.least(F.floor(point * (whole / PERIOD)), F.lit(whole - 1))
    cell = whole / CELLS if whole else 1.0
    drawn = spark.range(n).select(F.col("id").alias("slot"), place.alias("place")).withColumn(
        "cell", F.floor(F.col("place") / cell))
    ranges = goal.where("words > 0").select(
        "rank", "low", (F.col("low") + F.col("words")).alias("high"),
        F.explode(F.sequence(F.floor(F.col("low") / cell),
                             F.floor((F.col("low") + F.col("words")) / cell))).alias("cell"))
    met = written(
        drawn.join(ranges, "cell").where("place >= low and place < high").select("slot", "rank"),
        "slots")
    missed = goal.where("words > 0").join(met, "rank", "left_anti").select(
        (F.lit(n) + F.col("rank")).alias("slot"), "rank")
    all_slots = met.union(missed)
    return written(number_rows(all_slots, ["rank"], "slot", "block"), "plan")


def _edge(block: Column) -> Column:
    """First word of a block in its source's passes."""
    return F.when(block >= F.col("blocks"), F.col("words")).otherwise(
        F.floor(block * (F.col("words") / F.col("blocks"))))


def _placed(rows: DataFrame, goal: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's rank, goal, and blocks, and their place in its hash order."""
    counts = plan.groupBy("rank").agg(F.count(F.lit(1)).alias("blocks"))
    goal = goal.join(counts, "rank", "left")
    bucket = F.substring("key", 1, _digits(rows.count()))
    joined = (
        rows.alias("d").join(goal.alias("g"), F.expr("d.source <=> g.source"))
        .select("d.*", "rank", "source_size", "target", "words", "blocks")
        .withColumn("bucket", bucket))
    order = [F.asc("key"), F.asc("doc_id"), F.asc("size"), F.asc("text_key")]
    return written(sum_before(joined, ["rank"], "bucket", order, "size", "start"), "placed")


def _pieces(placed: DataFrame, plan: DataFrame) -> DataFrame:
    """(slot, rank, block, bucket, row, doc_id, from_word, n): what each slot takes."""
    first = F.col("start") + F.col("pass") * F.col("source_size")
    cut = (
        placed.where("size > 0 and words > 0")
        .withColumn("pass", F.explode(F.array(*map(F.lit, range(PASSES)))))
        .withColumn("first", first)
        .withColumn("end", F.least(F.col("first") + F.col("size"), F.col("words")))
        .where("first < end"))
    length = F.col("words") / F.col("blocks")
    near = F.sequence(
        F.greatest(F.floor(F.col("first") / length) - 1, F.lit(0)),
        F.least(F.floor(F.col("end") / length) + 1, F.col("blocks") - 1))
    begin = F.greatest("first", _edge(F.col("block")))
    pieces = (
        cut.withColumn("block", F.explode(near))
        .withColumn("begin", begin)
        .withColumn("n", F.least(F.col("end"), _edge(F.col("block") + 1)) - F.col("begin"))
        .where("n > 0")
        .select("rank", "block", "bucket", "row", "doc_id",
                (F.col("begin") - F.col("first")).alias("from_word"), "n"))
    return pieces.join(plan, ["rank", "block"])


def schedule(docs: DataFrame) -> DataFrame:
    """(slot, source, doc_id, from_word, n): the mix in order of its slots, each made of
    stretches of documents.

    Null texts and texts without words are in no slot. A null source is a source, the last.
    Repeated rows are rows of their own, and rows with null ids are put in order like others.
    Other columns than doc_id, source, and text are not read. An empty table gives no slots.
    """
    rows = sized(docs)
    goal = targets(rows)
    plan = slots(goal)
    pieces = _pieces(_placed(rows, goal, plan), plan)
    return pieces.join(goal.select("rank", "source"), "rank").select(
        "slot", "source", "doc_id", "from_word", "n")


def _taken(docs: DataFrame) -> DataFrame:
    rows = sized(docs)
    goal = targets(rows)
    plan = slots(goal)
    placed = _placed(rows, goal, plan)
    sums = _pieces(placed, plan).groupBy("rank", "bucket", "row").agg(
        F.sum("n").alias("taken"))
    return placed.join(sums, ["rank", "bucket", "row"], "left").withColumn(
        "taken", F.coalesce("taken", F.lit(0)))


def taken(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of ``docs``; the cases are
    those of ``schedule``, whose words are summed by row."""
    return _taken(docs).select("doc_id", "size", "source_size", "target", "taken")


def repeated(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them: words taken by size, rounded. Rows
    without words are in no slot, so they are left out. All columns are kept."""
    copies = written(
        _taken(docs).where("size > 0").groupBy("doc_id", "source", "key", "text_key")
        .agg((F.sum("taken") / F.sum("size")).alias("share"))
        .withColumn("copies", F.floor(F.col("share") + 0.5).cast("int"))
        .where("copies > 0").select("key", "text_key", "source", "copies"), "copies")
    rows = packed(
        docs,
        F.md5(F.coalesce(docs.doc_id.cast("string"), F.lit("")).cast("binary")).alias("_key"),
        F.md5(F.coalesce(docs.text, F.lit("")).cast("binary")).alias("_text"),
        docs.source.alias("_source"))
    joined = rows.join(
        copies, F.expr("_key = key and _text = text_key and _source <=> source"))
    return unpacked(joined.withColumn("_n", F.explode(F.sequence(F.lit(1), "copies"))),
                    docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS key,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(text, '')) AS text_key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
w AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
    2 * source_size AS cap FROM s),
o AS (
  SELECT *, row_number() OVER p AS seq,
    coalesce(sum(cap) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done,
    sum(weight) OVER (p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM w WINDOW p AS (ORDER BY cap / weight, rank)),
l AS (
  SELECT arg_min((t - done::DOUBLE) / rest::DOUBLE, seq) AS level
  FROM o, (SELECT 1.5 * sum(size)::DOUBLE AS t FROM d)
  WHERE (t - done::DOUBLE) / rest::DOUBLE <= cap / weight),
g AS (SELECT o.*, least(cap::DOUBLE, weight * level) AS target FROM o, l),
p AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
    round(g.target)::BIGINT AS words,
    coalesce(sum(d.size) OVER (
      PARTITION BY g.rank ORDER BY d.key, d.doc_id NULLS FIRST, d.size, d.text_key
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(start + size, words) - start)
   + greatest(0, least(source_size + start + size, words) - source_size - start))::BIGINT AS taken
FROM p
"""
