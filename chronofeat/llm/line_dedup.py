"""Line dedup over content-defined chunks of lines.

A text is cut after every line at which a rolling hash over the hashes of the
last ``window`` lines hits a fixed residue, so boundaries depend on nearby
lines only and an insertion elsewhere shifts none of them.  Chunks of at least
``min_lines`` lines whose hash occurs in more than one place of the corpus are
compared byte by byte with the first such chunk; equal ones are removed.
Hashes are counted with partial aggregation, and only repeated chunks travel
with their text.

Chunks by themselves miss passages that hold no whole chunk, which is most
passages of a few lines.  :func:`passage_dedup` misses none: behind the chunks
come finer ones, with a boundary at every line, where no repeated chunk lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_SPACE, let, materialise, text_or_empty

#: Multipliers of the rolling hash, newest line first (fixed values; products stay below 2**53).
ROLL = (1048573, 524287, 262139)


def line_chunks(text: Column, divisor: int = 4) -> Column:
    """Array of ``(first, n_lines, body)`` chunks of a text, in order.

    A boundary follows line ``i`` when the sum of the CRC-32 of lines ``i``,
    ``i-1``, ``i-2`` (0 before the start) times :data:`ROLL` leaves 0 modulo
    ``divisor`` after dropping 8 low bits; the last line always ends a chunk."""
    def cut(lines: Column) -> Column:
        crc = F.transform(lines, lambda x: F.crc32(x.cast("binary")))

        def rolled(h: Column, i: Column) -> Column:
            parts = [F.coalesce(F.get(h, i - k), F.lit(0).cast("bigint")) * F.lit(m) for k, m in enumerate(ROLL)]
            return F.shiftright(parts[0] + parts[1] + parts[2], 8) % F.lit(divisor)

        ends = let(crc, lambda h: F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (
            (i == F.size(lines) - 1) | (rolled(h, i) == 0))))
        return let(ends, lambda e: F.transform(e, lambda z, j: let(
            F.coalesce(F.get(e, j - 1) + 1, F.lit(0)), lambda a: F.struct(
                a.alias("first"), (z - a + 1).alias("n_lines"),
                F.array_join(F.slice(lines, a + 1, z - a + 1), "\n").alias("body")))))

    return let(F.split(text, "\n"), cut)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2,
               divisor: int = 4) -> DataFrame:
    """One row per input row: ``doc_id, text`` (without the removed chunks, the
    rest joined by line ends), ``n_lines``, ``n_removed_lines``,
    ``n_removed_chunks``.

    Of equal chunks the one with the smallest (id, place) stays, so each
    passage is left once in the corpus.  Chunks without a word are left alone.

    Defined cases: null text counts as empty (one empty line) and stays
    untouched; a null id ranks first; rows that repeat id and text are one
    document and come out alike, in one row each; a text of which all goes is
    empty; an empty table gives an empty result.  A repeated passage that holds
    no whole chunk stays (:func:`passage_dedup` removes it)."""
    text = text_or_empty(text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.xxhash64(F.col(id_col), text).alias("__cf_key"))
    cut = base.withColumn("chunks", line_chunks(F.col("text"), divisor))
    chunk = cut.select("doc_id", "__cf_key", F.posexplode("chunks").alias("nth", "c")) \
        .where((F.col("c.n_lines") >= min_lines) & F.col("c.body").rlike(r"[^\x20\x09-\x0D]")) \
        .select("doc_id", "__cf_key", "nth", F.xxhash64(F.col("c.body")).alias("hash"))
    chunk = materialise(chunk, "line-chunks")
    first = F.min(F.struct("doc_id", "__cf_key", "nth")).alias("first")
    repeated = chunk.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), first).where("n > 1").drop("n")
    places = chunk.join(repeated, "hash").select(
        "hash", "doc_id", "__cf_key", "nth",
        F.struct("doc_id", "__cf_key", "nth").eqNullSafe(F.col("first")).alias("stays"))
    by_doc = places.groupBy(F.col("doc_id").alias("p_id"), F.col("__cf_key").alias("p_key")) \
        .agg(F.collect_set(F.struct("nth", "hash", "stays")).alias("hits"))
    by_doc = materialise(by_doc, "line-hits")
    # hits have no size bound: the same merge join at every size, never a broadcast
    same = F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("__cf_key") == F.col("p_key"))
    bodies = base.join(by_doc.hint("merge"), same).dropDuplicates(["p_id", "p_key"]) \
        .withColumn("chunks", line_chunks(F.col("text"), divisor)) \
        .select("doc_id", "__cf_key", "chunks", F.explode("hits").alias("h")) \
        .select("doc_id", "__cf_key", "h.*", F.get(F.col("chunks"), F.col("h.nth"))["body"].alias("body"))
    bodies = materialise(bodies, "line-bodies")
    keep = bodies.where("stays").select("hash", F.col("body").alias("keep_body"))
    gone = bodies.where("not stays").join(keep, "hash").where(F.col("body") == F.col("keep_body")) \
        .groupBy(F.col("doc_id").alias("g_id"), F.col("__cf_key").alias("g_key")) \
        .agg(F.collect_set("nth").alias("gone"))
    same = F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("__cf_key") == F.col("g_key"))
    rows = base.join(gone.hint("merge"), same, "left").withColumn("chunks", F.when(
        F.col("gone").isNotNull(), line_chunks(F.col("text"), divisor)))
    left = F.filter(F.col("chunks"), lambda c, i: ~F.array_contains("gone", i))
    taken = F.filter(F.col("chunks"), lambda c, i: F.array_contains("gone", i))
    return rows.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(
            F.array_join(F.transform(left, lambda c: c["body"]), "\n")).alias("text"),
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
        F.coalesce(F.aggregate(taken, F.lit(0), lambda a, c: a + c["n_lines"]), F.lit(0)).cast("bigint")
        .alias("n_removed_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed_chunks"))


#: Cuts a text before every line with a word, so lines without one stay with the line before them.
_ITEM_END = r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])"


def line_units(items: Column, long_words: int, divisor: int, window: int) -> Column:
    """Array of ``(nth, n, digest)`` units, ``n`` lines from line ``nth`` on:

    * content-defined chunks of three lines or more: from one boundary line to
      the next, both included, so every pair of adjacent lines lies in exactly
      one chunk.  A line is a boundary where the sum of the CRC-32 of the last
      ``window`` lines times :data:`ROLL` leaves 0 modulo ``divisor`` after
      dropping 8 low bits; the first and the last line are boundaries too;
    * the finest chunks, with a boundary at every line: pairs of adjacent lines;
    * every line of over ``long_words`` words."""
    def sha(x: Column) -> Column:
        return F.sha2(x.cast("binary"), 256)

    def key(x: Column) -> Column:
        return F.unhex(sha(x))

    def units(lines: Column) -> Column:
        crc = F.transform(lines, lambda x: F.crc32(x.cast("binary")))
        digests = F.transform(lines, lambda x: F.when(x.rlike(NOT_SPACE), sha(x)))

        def boundary(h: Column, d: Column, i: Column) -> Column:
            parts = [F.coalesce(F.get(h, i - k), F.lit(0).cast("bigint")) * F.lit(ROLL[k]) for k in range(window)]
            rolled = F.shiftright(sum(parts[1:], parts[0]), 8) % F.lit(divisor)
            # a line without a word can only be the first
            return F.get(d, i).isNotNull() & (
                (rolled == 0) | (i == F.size(d) - 1) | (i == 0) | F.get(d, i - 1).isNull())

        def chunks(d: Column, ends: Column) -> Column:
            return F.filter(F.transform(ends, lambda a, j: let(
                F.coalesce(F.get(ends, j + 1) - a + 1, F.lit(0)), lambda n: F.struct(
                    a.alias("nth"), n.alias("n"),
                    F.when(n > 2, key(F.array_join(F.slice(d, a + 1, F.greatest(n, F.lit(0))), ""))).alias("digest")))),
                lambda u: u["digest"].isNotNull())

        coarse = let(digests, lambda d: let(crc, lambda h: let(
            F.filter(F.sequence(F.lit(0), F.size(d) - 1), lambda i: boundary(h, d, i)), lambda e: chunks(d, e))))
        return F.concat(coarse, let(digests, lambda d: F.concat(
            F.transform(d, lambda x, i: F.struct(
                i.alias("nth"), F.lit(2).alias("n"), key(F.concat(x, F.get(d, i + 1))).alias("digest"))),
            F.transform(lines, lambda x, i: F.struct(
                i.alias("nth"), F.lit(1).alias("n"),
                # that many words take twice as many characters at least
                F.when((F.length(x) > 2 * long_words) & (F.regexp_count(x, F.lit(NOT_SPACE + "+")) > long_words),
                       F.unhex(F.get(d, i))).alias("digest"))))))

    return F.filter(let(unit_lines(items), units), lambda u: u["digest"].isNotNull())


def unit_lines(items: Column) -> Column:
    """The line with a word of every item, without the lines that follow it."""
    return F.transform(items, lambda x: F.substring_index(x, "\n", 1))


def passage_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_words: int = 50,
                  divisor: int = 4, window: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, text`` (without the removed lines),
    ``n_lines``, ``n_removed_lines``, ``n_removed_chunks`` (removed stretches).

    A passage is two adjacent lines or more, or one line of over ``long_words``
    words.  A line goes wherever it belongs to a passage that stands at a
    smaller (id, place) too, so every occurrence of a passage but the first is
    removed whole.  The first place of a line always stays: the passage's
    first occurrence holds the line at a smaller place.

    Repeated content-defined chunks (:func:`line_units`) find the passages;
    the finest chunks carry each match on, line by line, to the ends of the
    passage.  They are looked at only outside the chunks that go: a pair of
    lines inside one never is the pair's first place.  Digests only choose
    candidates.  The texts of candidates are compared with the text at the first
    place, and unequal ones stay.

    Lines without a word are no part of a passage and go with the line before
    them.  Single lines of up to ``long_words`` words stay.

    Defined cases: as in :func:`line_dedup`."""
    text = text_or_empty(text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.xxhash64(F.col(id_col), text).alias("__cf_key"))
    items = F.split("text", _ITEM_END)
    units = base.select("doc_id", "__cf_key", F.explode(line_units(items, long_words, divisor, window)).alias("u")) \
        .select("doc_id", "__cf_key", "u.*")
    units = materialise(units, "line-units")
    place = F.struct("doc_id", "__cf_key", "nth")
    firsts = units.groupBy("digest").agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("first")).where("c > 1").drop("c")
    # written first, so both sides of the join are plain exchanges and Spark can split a common passage's places
    hits = units.join(materialise(firsts, "line-firsts").hint("merge"), "digest") \
        .select("doc_id", "__cf_key", "nth", "n", "digest", place.eqNullSafe(F.col("first")).alias("stays"))
    # one document's hits: the furthest end of the chunks that go and begin up to here
    upto = Window.partitionBy("doc_id", "__cf_key").orderBy("nth", F.desc("n")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.max(F.when((F.col("n") > 2) & ~F.col("stays"), F.col("nth") + F.col("n"))).over(upto)
    hits = hits.withColumn("covered", covered) \
        .where((F.col("n") > 2) | F.col("covered").isNull() | (F.col("covered") < F.col("nth") + F.col("n")))
    by_doc = hits.groupBy(F.col("doc_id").alias("p_id"), F.col("__cf_key").alias("p_key")) \
        .agg(F.collect_set(F.struct("nth", "n", "digest", "stays")).alias("hits"))
    by_doc = materialise(by_doc, "line-hits")
    # hits have no size bound: the same merge join at every size, never a broadcast
    same = F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("__cf_key") == F.col("p_key"))
    bodies = base.join(by_doc.hint("merge"), same).select(
        "doc_id", "__cf_key", F.explode(let(unit_lines(items), lambda lines: F.transform("hits", lambda h: F.struct(
            h["nth"].alias("nth"), h["n"].alias("n"), h["digest"].alias("digest"), h["stays"].alias("stays"),
            F.array_join(F.slice(lines, h["nth"] + 1, h["n"]), "\n").alias("body"))))).alias("h")) \
        .select("doc_id", "__cf_key", "h.*")
    bodies = materialise(bodies, "line-bodies")
    # rows that repeat id and text share their place: one body each digest
    kept = bodies.where("stays").groupBy("digest").agg(F.min("body").alias("kept_body"))
    again = bodies.where(~F.col("stays")).join(materialise(kept, "line-kept").hint("merge"), "digest") \
        .where(F.col("body") == F.col("kept_body"))
    gone = again.groupBy(F.col("doc_id").alias("g_id"), F.col("__cf_key").alias("g_key")) \
        .agg(F.collect_set(F.struct("nth", "n")).alias("hits"))
    gone = gone.select("g_id", "g_key", F.array_sort(F.array_distinct(F.flatten(F.transform(
        "hits", lambda h: F.sequence(h["nth"], h["nth"] + h["n"] - 1))))).alias("gone"))
    gone = materialise(gone, "line-gone")
    # no size bound: the same merge join at every size, never a broadcast
    same = F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("__cf_key") == F.col("g_key"))
    rows = base.join(gone.hint("merge"), same, "left")

    def left(items: Column) -> Column:
        bounds = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.size(items)))
        return let(bounds, lambda b: F.array_join(F.flatten(F.transform(F.slice(b, 2, F.size(b)), lambda z, j: let(
            F.get(b, j), lambda a: F.slice(items, a + 2, z - a - 1)))), "\n"))

    def lines_of(items: Column) -> Column:
        return F.aggregate("gone", F.lit(0), lambda n, i: n + F.size(F.split(F.get(items, i), "\n")))

    stretches = F.size(F.filter("gone", lambda x, j: (j == 0) | (F.get("gone", j - 1) != x - 1)))
    rows = rows.withColumn("items", F.when(F.col("gone").isNotNull(), F.split("text", _ITEM_END)))
    return rows.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(let(F.col("items"), left)).alias("text"),
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
        F.coalesce(let(F.col("items"), lines_of), F.lit(0)).cast("bigint").alias("n_removed_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(stretches).cast("bigint").alias("n_removed_chunks"))
