"""Line dedup by levelled sorted runs of line hashes, with DataFrame functions only.

A line's key is the line without blanks at both ends, A-Z in lower case. Keys of enough
characters that enough documents hold lose all their lines, except in the document of the
greatest id that holds them.

Documents are dealt to batches by id, greatest first. A batch counts the documents of each of
its keys and looks for the keys in the runs that earlier batches left: a key that a run already
knows to be common needs no further entry (merge-anti-join), all others are the batch's own
run, sorted by hash. When a level holds ``fanout`` runs they are merged into one of
the next level. The runs together then name the common keys and the document that keeps each.

What moves: line hashes (two of 64 bits, an id and a place a line), counted with partial sums by
key and document first, so that a line of every document is no heavier than others. To meet the
lines again, keys with more than 1/``SHARES`` of all lines are broadcast (there are at most
``SHARES`` times the number of batches of them); every other key is small. Texts are shuffled
once, to meet the places of their dropped lines. A task holds one text at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path, stored

BLANKS = " \t\n\x0b\x0c\r"
SHARES = 4096
KEY = ["__h1", "__h2"]


def line_key(line: Column) -> Column:
    """Blanks at both ends go; A-Z in lower case, other letters stay."""
    line = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(line) == F.char_length(line)
    lowered = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(ascii_only, F.lower(line)).otherwise(lowered)


def lines_of(text: Column) -> Column:
    """The lines between newlines; NULL and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(__id, __text, __at, __h1, __h2) of each line whose key has ``min_chars`` code points.

    ``__text`` is a hash of the whole text, which tells rows of one id apart.
    """
    each = docs.select("__id", "__text", F.posexplode(lines_of(F.col("text"))).alias("__at", "line"))
    keyed = each.select("__id", "__text", "__at", line_key(F.col("line")).alias("key"))
    keyed = keyed.where(F.char_length("key") >= min_chars)
    hashes = [F.xxhash64(F.lit(seed), "key").alias(h) for seed, h in enumerate(KEY)]
    return keyed.select("__id", "__text", "__at", *hashes)


class Runs:
    """Levelled sorted runs of (hash, documents, lines, greatest id) in the shared folder.

    Ids of later batches must be smaller than those of earlier ones.
    """

    def __init__(self, min_docs: int, fanout: int):
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = []

    def _written(self, run: DataFrame) -> DataFrame:
        """Rows of one hash are in one file, and files are sorted by hash."""
        return stored(run.sortWithinPartitions(*KEY), "line-run")

    def merged(self, runs: list[DataFrame]) -> DataFrame:
        every = reduce(DataFrame.unionByName, runs)
        return every.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.sum("lines").alias("lines"), F.max("last").alias("last"))

    @property
    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame, heavy: int) -> None:
        """A batch's lines; keys known to be common are left out unless over ``heavy`` lines."""
        by_document = lines.groupBy(*KEY, "__id").agg(F.count(F.lit(1)).alias("lines"))
        own = by_document.groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("docs"), F.sum("lines").alias("lines"), F.max("__id").alias("last")
        )
        light = own
        for run in self.all:
            known = run.where(F.col("docs") >= self.min_docs).select(*KEY, F.lit(True).alias("__known"))
            light = light.join(known, KEY, "left").where(F.col("__known").isNull() | (F.col("lines") > heavy))
            light = light.drop("__known")
        self._put(0, self._written(light))

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._written(self.merged(full)))

    def common(self) -> DataFrame:
        """(hash, lines, last) of every key that enough documents hold."""
        return self.merged(self.all).where(F.col("docs") >= self.min_docs).select(*KEY, "lines", "last")


def drop_common_lines(
    docs: DataFrame, min_docs: int = 3, min_chars: int = 20, batches: int = 6, fanout: int = 3
) -> DataFrame:
    """Every row with n_lines, n_dropped and kept_text.

    Ids are whole numbers. Rows of one id are one document when documents are counted, and each
    keeps its own text. Rows without an id count as one document, below all others. A NULL text
    is one empty line. A line that stands several times in the keeping document stays each
    time. Repeated rows and ties of ids give equal rows back; a table without rows gives none.
    Input columns named as a result, or starting with two underscores, give way.
    """
    spark = docs.sparkSession
    own = ("n_lines", "n_dropped", "kept_text")
    docs = docs.select(*[c for c in docs.columns if c not in own and not c.startswith("__")])
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("bigint"), "__text": F.xxhash64(F.coalesce("text", F.lit("")))})
    shares = [i / batches for i in range(1, batches)]
    cuts = sorted(set(keyed.agg(F.percentile_approx("__id", shares, 10_000)).first()[0] or [])) if shares else []
    # Batch 0 holds the greatest ids, the last one those without an id.
    batch = F.lit(len(cuts))
    for i, cut in enumerate(cuts):
        batch = F.when(F.col("__id") > cut, F.lit(len(cuts) - 1 - i)).otherwise(batch)
    found = long_lines(keyed, min_chars).withColumn("__batch", batch)
    path = fresh_path(spark, "lines")
    found.write.partitionBy("__batch").parquet(path)
    lines = spark.read.schema(found.schema).parquet(path)

    heavy = -(-lines.count() // SHARES)
    runs = Runs(min_docs, fanout)
    for i in range(len(cuts) + 1):
        runs.add(lines.where(F.col("__batch") == i), heavy)
    common = stored(runs.common(), "common-lines")
    hot, cold = common.where(F.col("lines") > heavy), common.where(F.col("lines") <= heavy)

    goes = F.col("__id").isNull() | (F.col("__id") < F.col("last"))
    marked = lines.drop("__batch").join(F.broadcast(hot.select(*KEY, "last")), KEY, "left")
    rest = marked.where(F.col("last").isNull()).drop("last").join(cold.select(*KEY, "last"), KEY)
    where = ["__id", "__text", "__at"]
    dropped = marked.where(F.col("last").isNotNull() & goes).select(*where).unionByName(rest.where(goes).select(*where))
    # At most the lines of one text are collected.
    places = dropped.groupBy("__id", "__text").agg(F.collect_set("__at").alias("__dropped"))
    places = places.withColumnsRenamed({"__id": "__pid", "__text": "__ptext"})

    # Lines are cut before the join, so that they are a column there and not cut again for each place.
    cut = keyed.withColumn("__lines", lines_of(F.col("text"))).withColumn("__null", F.col("text").isNull()).drop("text")
    met = cut.join(
        places, F.col("__id").eqNullSafe(F.col("__pid")) & (F.col("__text") == F.col("__ptext")), "left"
    )
    places_kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    kept = F.transform(places_kept, lambda at: F.col("__lines")[at])
    whole = F.array_join("__lines", "\n")
    n_lines = F.size("__lines").cast("bigint")
    out = met.withColumns({
        "text": F.when(~F.col("__null"), whole),
        "n_lines": n_lines,
        "n_dropped": F.when(F.col("__dropped").isNull(), F.lit(0)).otherwise(F.size("__dropped")).cast("bigint"),
        "kept_text": F.when(F.col("__dropped").isNull(), whole).otherwise(F.array_join(kept, "\n")),
    })
    return out.select(*docs.columns, *own)
