"""Mixing sources to target weights on a low-discrepancy schedule.

Each source's documents are shuffled (by hash) and laid end to end as one stream of
words, cut into equal blocks: as many as it takes for none to be above ``BLOCK_WORDS``
words, all of the same length or one word apart.  A source gets the slots that its target
needs, no more: whole blocks, and a last one that is cut where the target is reached.  So
a source's taken words are its target, rounded to a word, however small the source is.

The schedule interleaves the sources.  All slots stand side by side by source, which
divides their range by the cumulative targets (in blocks); the slot at place r of it gets
the position that reverses r's bits, a van der Corput point.  Read by position, every
prefix of the schedule has nearly the target mix.  A slot's rank among its source's slots
names the block; past the last block the source begins again (epoch 1).

Slots, blocks and fragments are joined by (source, block), which no source makes
uneven.  Sources are ranked by a prefix over ranges, so there may be many.

Defined cases: a null source is a source of its own, last in order; null and
word-free texts have size 0 and take 0; a corpus without words takes nothing; a source with
words takes at least one; repeated rows are rows of their own and are laid one behind the
other; an empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import hash52, pick, running, staged, word_count
from shelfcast.operators import prefix
from shelfcast.operators.joins import bounded_broadcast

WEIGHTS = (5, 2, 1)          # of the sources in code point order, repeating
SHARE = 1.5                  # words of the mix, over the words there are
MOST = 2                     # a source's target, over its words
BLOCK_WORDS = 64             # of a block at most
CHUNK = 1 << 16              # slots made, and ranked, together


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, src, no_src, size and the shuffle order; no texts from here on."""
    return pick(docs, "doc_id", "text", "source").select(
        "doc_id", F.coalesce("source", F.lit("")).alias("src"), F.col("source").isNull().cast("int").alias("no_src"),
        word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("sum"),
    ).withColumn("h", hash52(F.lit("mix"), F.col("doc_id"), F.col("sum")))


def targets(rows: DataFrame) -> DataFrame:
    """src, no_src, source_size, target, base (words of the sources before): sources above MOST times their size stop there and the
    rest is shared by weight among the others, again and again; only sums over the table of
    sources come to the driver."""
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    per = rows.groupBy("src", "no_src").agg(F.sum("size").cast("long").alias("source_size"), F.lit(1).cast("long").alias("one"))
    ranked = prefix.running_sums(per, [("no_src", True), ("src", True)], {"rank": "one", "upto": "source_size"}).drop("one")
    per = staged(ranked.withColumn("w", F.element_at(weights, ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))), "mix-sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    rest, free, full = SHARE * total, -1, F.lit(False)
    while True:
        used, w, n = per.agg(F.sum(F.when(full, MOST * F.col("source_size"))),
                             F.sum(F.when(~full, F.col("w"))), F.count(F.when(~full, 1))).first()
        rest, w = SHARE * total - (used or 0), w or 0
        if n == free:
            break
        free, full = n, MOST * F.col("source_size") * F.lit(w) <= F.col("w") * F.lit(rest)
    target = F.when(full, (MOST * F.col("source_size")).cast("double")).otherwise(
        F.lit(float(rest)) * F.col("w") / F.lit(float(w or 1)))
    return per.select("src", "no_src", "source_size", target.alias("target"),
                      (F.col("upto") - F.col("source_size")).cast("long").alias("base"))


def cut(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The sources with their blocks and slots: ``blocks`` equal ones, of ``short`` words but for the
    first ``longer`` ones that have one more; ``take`` words in ``slots`` slots, the first of
    them at place ``lo`` of the schedule's range."""
    whole = F.least(F.greatest(F.floor(F.col("target") + 0.5).cast("long"), F.lit(1)), MOST * F.col("source_size"))
    rest = "(take % source_size)"
    some = f"CASE WHEN {rest} <= longer * (short + 1) THEN ({rest} + short) DIV (short + 1) ELSE longer + ({rest} - longer * (short + 1) + short - 1) DIV short END"
    out = (sources.where("source_size > 0")
           .withColumn("take", whole)
           .withColumn("blocks", F.expr(f"(source_size + {block_words - 1}) DIV {block_words}"))
           .withColumn("short", F.expr("source_size DIV blocks")).withColumn("longer", F.expr("source_size % blocks"))
           .withColumn("slots", F.expr(f"(take DIV source_size) * blocks + {some}")))
    placed = prefix.running(out, [("no_src", True), ("src", True)], {"lo": ("sum", "slots")}, exclusive=True)
    return placed.withColumn("lo", F.col("lo").cast("long"))


def block_start(block: Column) -> Column:
    """Where a block begins in its source's stream."""
    return block * F.col("short") + F.least(block, F.col("longer"))


def block_of(word: Column) -> Column:
    """The block that holds a word of its source's stream."""
    long_part = F.col("longer") * (F.col("short") + 1)
    return F.when(word < long_part, F.floor(word / (F.col("short") + 1))).otherwise(
        F.col("longer") + F.floor((word - long_part) / F.col("short"))).cast("long")


def schedule(sources: DataFrame) -> DataFrame:
    """slot (its order), src, no_src, block, epoch, use (words of the block that are taken).

    ``sources`` as from ``cut``."""
    bits = max(1, int((sources.agg(F.sum("slots")).first()[0] or 0)).bit_length())
    chunks = sources.where("slots > 0").withColumn("first", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("slots") - 1, F.lit(CHUNK).cast("long"))))
    # a stated number of partitions is kept: by their bytes these few rows would make one
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = chunks.repartition(n, "src", "no_src", "first").withColumn(
        "j", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + CHUNK, F.col("slots")) - 1)))
    turned = F.conv(F.reverse(F.lpad(F.bin(F.col("lo") + F.col("j")), bits, "0")), 2, 10).cast("long")
    drawn = places.withColumn("slot", turned).withColumn("part", F.shiftright("slot", max(0, bits - 12)))
    ranked = running(drawn.drop("first", "j"), ["src", "no_src"], "part", [F.col("slot")], F.lit(1), "rank", generated=True)
    block, epoch = F.col("rank") % F.col("blocks"), F.floor(F.col("rank") / F.col("blocks")).cast("long")
    before = epoch * F.col("source_size") + block_start(block)
    return ranked.select("slot", "src", "no_src", block.alias("block"), epoch.cast("int").alias("epoch"), F.least(
        F.col("take") - before, block_start(block + 1) - block_start(block)).alias("use"))


def streams(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with ``start``: the words before a document in its source's shuffled stream.

    One prefix over ranges of (source, hash, row): neither a hot source nor a row that is
    repeated in a third of the table makes a task uneven."""
    order = [("no_src", True), ("src", True), ("h", True), ("sum", True), ("row", True)]
    laid = prefix.running(rows, order, {"before": ("sum", "size")}, exclusive=True)
    base = bounded_broadcast(sources.select("src", "no_src", "base"))
    return laid.join(base, ["src", "no_src"]).withColumn("start", (F.col("before") - F.col("base")).cast("long")).drop(
        "before", "base", "row")


def fragments(laid: DataFrame, sources: DataFrame) -> DataFrame:
    """The part of each document that lies in each block: doc_id, start, size, src, no_src,
    block, and ``at``, ``words``: where in the block it begins and how many words it has."""
    end = F.col("start") + F.col("size")
    facts = bounded_broadcast(sources.select("src", "no_src", "short", "longer"))
    in_blocks = laid.where("size > 0").join(facts, ["src", "no_src"]).withColumn(
        "block", F.explode(F.sequence(block_of(F.col("start")), block_of(end - 1))))
    begin = F.greatest(F.col("start"), block_start(F.col("block")))
    return in_blocks.select(
        "doc_id", "start", "size", "src", "no_src", "block", (begin - block_start(F.col("block"))).alias("at"),
        (F.least(end, block_start(F.col("block") + 1)) - begin).alias("words"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows laid out, sources, the mix): the mix has one row per slot and fragment drawn,
    in ``slot`` order the training order: slot, epoch, doc_id, src, no_src, start, size, block, at, words."""
    rows = staged(sized(docs).withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    sources = staged(targets(rows), "mix-targets")
    blocks = staged(cut(sources, block_words), "mix-blocks")
    laid = streams(rows, sources)
    # the schedule is made from a few rows, so Spark takes it for small; it grows with the words
    drawn = fragments(laid, blocks).join(schedule(blocks).hint("merge"), ["src", "no_src", "block"])
    used = F.greatest(F.lit(0).cast("long"), F.least(F.col("words"), F.col("use") - F.col("at")))
    return laid, sources, drawn.withColumn("words", used).where("words > 0").drop("use")


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The digest: doc_id, size, source_size, target, taken; one row for each row of ``docs``."""
    laid, sources, drawn = mix(docs, block_words)
    taken = drawn.groupBy("src", "no_src", "start").agg(F.sum("words").alias("taken"))
    with_words = laid.where("size > 0").join(taken, ["src", "no_src", "start"], "left")
    without = laid.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return with_words.unionByName(without).join(bounded_broadcast(sources), ["src", "no_src"]).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def repeat_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, columns as they are: one copy for
    each epoch that takes at least half of a document's words, and at least one of a source's first
    document, so that no source with words is lost.  Texts without words are in no
    block and are left out.  Copies are found by doc_id and checksum; only the texts of rows
    that are kept move, once."""
    laid, _, drawn = mix(docs, block_words)
    per_epoch = drawn.groupBy("src", "no_src", "start", "epoch", "size", "doc_id").agg(F.sum("words").alias("words"))
    enough = (2 * F.col("words") >= F.col("size")) | ((F.col("start") == 0) & (F.col("epoch") == 0))
    taken = per_epoch.where(enough).groupBy("src", "no_src", "start").agg(F.count(F.lit(1)).alias("__times"))
    # equal rows (doc_id and text) share a key: each of them gets the group's copies in turn
    key = ["__doc", "__none", "__sum", "__src", "__no_src"]
    named = laid.where("size > 0").join(taken, ["src", "no_src", "start"]).select(
        F.coalesce("doc_id", F.lit(0)).alias("__doc"), F.col("doc_id").isNull().cast("int").alias("__none"),
        F.col("sum").alias("__sum"), F.col("src").alias("__src"), F.col("no_src").alias("__no_src"), "__times")
    times = named.groupBy(*key).agg(F.sum("__times").alias("__times"))
    keyed = docs.withColumns({
        "__doc": F.coalesce("doc_id", F.lit(0)), "__none": F.col("doc_id").isNull().cast("int"),
        "__sum": F.md5(F.coalesce("text", F.lit("")).cast("binary")),
        "__src": F.coalesce("source", F.lit("")), "__no_src": F.col("source").isNull().cast("int")})
    copies = keyed.join(times, key).dropDuplicates(key)
    return copies.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).drop(
        *key, "__times", "__copy")


# Targets by trying how many sources, in order of 2 * size / weight, stop at their cap; taken
# words as the first round(target) words of the source's stream, which begins again when it ends.
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS src, CAST(source IS NULL AS INTEGER) AS no_src,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5(coalesce(text, '')) AS sum FROM documents),
h AS (SELECT *, CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), chr(0)) || ':' || sum), 1, 13)) AS BIGINT) AS h FROM d),
per AS (SELECT src, no_src, CAST(sum(size) AS BIGINT) AS source_size,
               [{", ".join(map(str, WEIGHTS))}][CAST((row_number() OVER (ORDER BY no_src, src) - 1) % {len(WEIGHTS)} + 1 AS INTEGER)] AS w
        FROM h GROUP BY src, no_src),
k AS (SELECT *, row_number() OVER (ORDER BY source_size / w, no_src, src) AS k FROM per),
c AS (SELECT a.k, {SHARE} * (SELECT sum(source_size) FROM per) - coalesce(sum({MOST} * b.source_size) FILTER (WHERE b.k < a.k), 0) AS rest,
             sum(b.w) FILTER (WHERE b.k >= a.k) AS free FROM k a, k b GROUP BY a.k),
f AS (SELECT coalesce(min(c.k), 1000000000) AS k FROM c JOIN k USING (k) WHERE {MOST} * k.source_size * c.free > k.w * c.rest),
t AS (SELECT k.*, CASE WHEN k.k < f.k THEN CAST({MOST} * source_size AS DOUBLE)
                       ELSE CAST(c.rest AS DOUBLE) * w / CAST(c.free AS DOUBLE) END AS target
      FROM k CROSS JOIN f LEFT JOIN c ON c.k = f.k),
g AS (SELECT *, greatest(least(CAST(floor(target + 0.5) AS BIGINT), {MOST} * source_size), least(1, source_size)) AS take FROM t),
l AS (SELECT h.*, CAST(coalesce(sum(size) OVER (PARTITION BY src, no_src ORDER BY h, doc_id NULLS LAST, sum
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM h),
e AS (SELECT l.doc_id, l.size, g.source_size, g.target, l.start, g.take FROM l JOIN g USING (src, no_src))
SELECT doc_id, size, source_size, target, CAST(
  greatest(0, least(size, take - start)) + greatest(0, least(size, take - source_size - start)) AS BIGINT) AS taken FROM e
"""
