"""Document fingerprints of closed syncmers, in built-in functions only.

A k-mer (k code points) is chosen if the least of its inner substrings, by hash, is its first or its
last one. That depends on the k-mer alone, so what stands before or after a passage changes none of
its anchors, and anchors can be matched by place. The fingerprint of a text keeps, of the distinct
chosen k-mers of the whole text, those with the least hashes, each with its first place; two
fingerprints give an unbiased estimate of the Jaccard similarity of all chosen k-mers.

As anchors need no context, an edited text is not read again: its fingerprint is the least of the
anchors inside the part that stayed, of those inside the part taken from the next text, which are
that text's own, moved, and of those of the few k-mers that lie across the cut.

Texts are cut into chunks that overlap by k - 1 code points, so memory beside the text is bounded.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.llm import runtime
from lendmill.session import materialize

INNER = 9  # code points of an inner substring
SPAN = 16  # inner substrings of a k-mer
STRIDE = 4  # hashes of which the least is found first; SPAN is a multiple
K = INNER + SPAN - 1
KEPT = 64
CHUNK = 4096
COPIES_AT_ONCE = 4096
RANGE_ROWS = 1 << 16
# What a row needs of the next one.
NEXT = ["text", "full", "lent"]
ANCHORS = "array<struct<h:bigint,p:int>>"
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, in_place_edited double"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _anchors(piece: Column, base: Column) -> Column:
    """(hash, place) of the chosen k-mers of a piece that begins at place `base`."""
    inner = F.transform(F.regexp_extract_all(piece, F.lit(f"(?s)(?=(.{{{INNER}}}))."), F.lit(1)), lambda s: F.xxhash64(s))

    def chosen(hashes: Column, least: Column) -> Column:
        """`least` holds the least of STRIDE hashes from each place on."""

        def one(x: Column, i: Column) -> Column:
            first, last = F.get(hashes, i), F.get(hashes, i + (SPAN - 1))
            others = lambda steps: [F.get(least, i + k) for k in steps]
            # the nearest first: most places fail there, and what comes after is not looked at
            leads = reduce(and_, [first <= low for low in others(range(STRIDE, SPAN, STRIDE))], first == x)
            ends = reduce(and_, [last <= low for low in others(range(SPAN - 2 * STRIDE, 0, -STRIDE))], last == F.get(least, i + (SPAN - STRIDE))) & (last <= x)
            # three inner substrings cover the k-mer
            return F.when(leads | ends, F.struct(F.xxhash64(first, F.get(hashes, i + INNER), last).alias("h"), (base + i).alias("p")))

        whole = F.slice(least, 1, F.greatest(F.size(least) - (SPAN - 1), F.lit(0)))
        return F.filter(F.transform(whole, one), lambda a: a.isNotNull())

    def strided(hashes: Column) -> Column:
        return F.transform(hashes, lambda x, i: F.least(x, *[F.get(hashes, i + k) for k in range(1, STRIDE)]))

    return _let(inner, lambda hashes: _let(strided(hashes), lambda least: chosen(hashes, least)))


def _distinct(anchors: Column) -> Column:
    """The anchors by hash, each hash at its first place."""
    return _let(F.sort_array(anchors), lambda s: F.filter(s, lambda a, i: (i == 0) | (a["h"] != F.get(s, i - 1)["h"])))


def _least(anchors: Column) -> Column:
    """The KEPT distinct anchors of least hash, each at its first place."""
    return F.slice(_distinct(anchors), 1, KEPT)


def sketch(text: Column, heads: dict[str, Column]) -> Column:
    """`full`, the least anchors of the text, and for each of `heads` those that end within so many of its first code points."""

    def of_chunk(chunks: Column) -> Callable[[Column, Column], Column]:
        def run(chunk: Column, j: Column) -> Column:
            piece = F.concat(chunk, F.coalesce(F.substring(F.get(chunks, j + 1), 1, K - 1), F.lit("")))
            # the first place of a hash is inside a head if any of its places is: one order serves all
            inside = lambda found, head: _let(head - K, lambda last: F.slice(F.filter(found, lambda a: a["p"] <= last), 1, KEPT))
            return _let(
                _distinct(_anchors(piece, j * CHUNK)),
                lambda found: F.struct(F.slice(found, 1, KEPT).alias("full"), *[inside(found, head).alias(name) for name, head in heads.items()]),
            )

        return run

    per_chunk = _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), lambda chunks: F.transform(chunks, of_chunk(chunks)))
    merged = lambda found, part: _least(F.flatten(F.transform(found, lambda c: c[part])))
    return _let(per_chunk, lambda found: F.struct(*[merged(found, part).alias(part) for part in ("full", *heads)]))


def _or_whole(anchors: Column, text: Column) -> Column:
    """A text without a chosen k-mer is one anchor; an empty text has none."""
    whole = F.array(F.struct(F.xxhash64(text).alias("h"), F.lit(0).alias("p")))
    return F.when((F.size(anchors) == 0) & (text != ""), whole).otherwise(anchors)


def _hashes(anchors: Column) -> Column:
    return F.transform(anchors, lambda a: a["h"])


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity of the anchors of two texts, 1 for two empty ones."""

    def share(both: Column) -> Column:
        common = F.size(F.array_intersect(F.array_intersect(both, _hashes(a)), _hashes(b)))
        return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both))

    return _let(F.slice(F.sort_array(F.array_union(_hashes(a), _hashes(b))), 1, KEPT), share)


def in_place(a: Column, b: Column) -> Column:
    """Of the kept anchors that two fingerprints share, the part at the same place; null where they share none."""
    common = F.size(F.array_intersect(_hashes(a), _hashes(b)))
    return F.when(common > 0, F.size(F.array_intersect(a, b)) / common)


def written(anchors: Column) -> Column:
    """The fingerprint as text: hash and place of each anchor, by hash."""
    return F.array_join(F.transform(anchors, lambda a: F.concat(F.lpad(F.lower(F.hex(a["h"])), 16, "0"), F.lit(":"), a["p"].cast("string"))), ",")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key): keys ascend by falling doc_id (null last), then by the text's digest."""
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    falling = F.lpad(F.hex(F.bitwise_not("doc_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return rows.withColumn("key", F.concat(F.coalesce(falling, F.lit("Z")), F.sha2("text", 256)))


def _starts(keys: DataFrame) -> list[str]:
    """The first key of each range: as many ranges as shuffle partitions, more where a range would hold over RANGE_ROWS rows."""
    ranges = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-keys.count() // RANGE_ROWS))
    ranged = keys.select("key").repartitionByRange(ranges, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key"))
    return sorted(r["key"] for r in ranged.collect())


def _range_of(key: Column, starts: list[str]) -> Column:
    """The number of the range that a key is in, by binary search."""
    edges = F.expr("array(" + ", ".join(f"'{s}'" for s in starts[1:]) + ")") if len(starts) > 1 else F.array(F.lit(None).cast("string"))
    steps = [1 << b for b in reversed(range(len(starts).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: at + F.when(F.get(edges, at + (step - 1)) <= key, step).otherwise(0))


def _with_next(rows: DataFrame, starts: list[str]) -> DataFrame:
    """`rows` (doc_id, text, key; keys are unique) with their anchors and the next row's text and anchors.

    The first row of each range is also sent, as a guest, to the end of the range before it.
    """
    ranges = len(starts)
    at = rows.withColumn("range", _range_of(F.col("key"), starts))
    first = F.col("key") == F.get(F.expr("array(" + ", ".join(f"'{s}'" for s in starts) + ")"), F.col("range"))
    place = lambda where, guest: F.struct(where.cast("int").alias("range"), F.lit(guest).alias("guest"))
    places = F.when(first, F.array(place(F.col("range"), False), place(F.pmod(F.col("range") - 1, F.lit(ranges)), True))).otherwise(F.array(place(F.col("range"), False)))
    dealt = at.select("doc_id", "text", "key", F.explode(places).alias("place")).select("doc_id", "text", "key", "place.range", "place.guest")
    order = Window.partitionBy("range").orderBy("guest", "key")
    measured = _measured(dealt.repartitionById(ranges, "range"))
    sketched = _sketched(measured.withColumn("lent_chars", F.coalesce(F.lag("new_chars").over(order), F.lit(0))))
    led = sketched.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in NEXT])
    return led.filter(~F.col("guest"))


def _measured(rows: DataFrame) -> DataFrame:
    """With n_chars, head (code points that an edit leaves) and new_chars (those that it takes from the next text)."""
    n = F.char_length("text")
    new = F.floor(n / 3).cast("int")
    return rows.withColumns({"n_chars": n, "head": n - new, "new_chars": new})


def _sketched(rows: DataFrame) -> DataFrame:
    """With the anchors of the text, of its head and of its first `lent_chars` code points, which the text before it takes."""
    rows = rows.withColumn("found", sketch(F.col("text"), {"stayed": F.col("head"), "lent": F.col("lent_chars")}))
    return rows.withColumns({"full": _or_whole(F.col("found.full"), F.col("text")), "stayed": F.col("found.stayed"), "lent": F.col("found.lent")}).drop("found")


def _compared(rows: DataFrame) -> DataFrame:
    """The result for rows with anchors and a next text and its anchors."""
    stays = F.substring(F.col("text"), F.lit(1), F.col("head"))
    new = F.substring(F.col("next_text"), F.lit(1), F.col("new_chars"))
    base = F.greatest(F.col("head") - (K - 1), F.lit(0))
    across = F.concat(F.substring(F.col("text"), base + 1, F.col("head") - base), F.substring(F.col("next_text"), F.lit(1), F.least(F.col("new_chars"), F.lit(K - 1))))
    moved = F.transform("next_lent", lambda a: F.struct(a["h"].alias("h"), (a["p"] + F.col("head")).alias("p")))
    rows = rows.withColumns({"edited": F.concat(stays, new), "across": _anchors(across, base), "moved": moved})
    rows = rows.withColumn("new", F.concat("across", "moved"))
    rows = rows.withColumn("after", _or_whole(_least(F.concat("stayed", "new")), F.col("edited")))
    full, after = F.col("full"), F.col("after")
    return rows.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), written(full).alias("fingerprint"), written(after).alias("edited_fingerprint"),
        likeness(full, after).alias("near_edited"), likeness(full, F.col("next_full")).alias("near_next"), in_place(full, after).alias("in_place_edited"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, in_place_edited.

    The next document is the one with the next smaller doc_id, after the last the first. Null ids
    come last; rows that share an id follow one another by the digest of their text, so of rows
    repeated as a whole all but one have an equal next one. A null text counts as empty; an empty
    text has an empty fingerprint, which is like another empty one (1) and unlike all others (0).
    A text without a chosen k-mer is one anchor as a whole. A table of one row is its own next one.
    An empty table gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    keyed = _keyed(docs)
    keys = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies")), "document-keys")
    starts = _starts(keys)
    if not starts:
        return spark.createDataFrame([], SCHEMA)
    again = keys.filter("copies > 1")
    touched, rest = runtime.split_by_slots(keyed, "key", again, "key")
    once = touched.dropDuplicates(["key"])
    out = _compared(_with_next(rest.unionByName(once), starts))
    # of rows that repeat as a whole, all but one are followed by an equal one
    parts = again.select(F.col("key").alias("of"), F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 2) / COPIES_AT_ONCE))).alias("part"), (F.col("copies") - 1).alias("rows"))
    selves = once.join(parts, once["key"] == parts["of"]).select("doc_id", "text", "part", F.least(F.col("rows") - F.col("part") * COPIES_AT_ONCE, F.lit(COPIES_AT_ONCE)).alias("times"))
    selves = _sketched(_measured(selves.repartition("part", "text")).withColumn("lent_chars", F.col("new_chars")))
    selves = selves.withColumns({f"next_{c}": F.col(c) for c in NEXT})
    selves = _compared(selves.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))))
    return out.unionByName(selves)
