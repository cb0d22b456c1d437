"""Line dedup over levelled sorted runs of line hashes, with DataFrame functions only.

Documents come in batches from the largest key down. A run holds (hash, documents, last
document), sorted by hash. Each new batch is anti-joined with what the runs have settled
and adds the rest as a run of its own; whenever a level has ``fanout`` runs they are merged
into one of the next level. Counts add up and the last document is a maximum, so merging
is an aggregate with a map-side half: a line in a third of all documents is one row per
task before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.llm.common import discard, stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACE = " \t\n\x0b\x0c\r"
_NO_KEY = -(2**63)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(_SPACE))
    # lower() does the same as the table where every character is ASCII, and much faster.
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def lines_of(text: Column) -> Column:
    """Lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


class Runs:
    """Levelled runs of (h, n, last); a level never keeps more than ``fanout - 1`` runs."""

    def __init__(self, fanout: int, settled_at: int) -> None:
        self.fanout, self.settled_at = fanout, settled_at
        self.levels: list[list[DataFrame]] = []

    @staticmethod
    def _sorted(run: DataFrame) -> DataFrame:
        return stored(run.sortWithinPartitions("h"))

    @staticmethod
    def merged(runs: list[DataFrame]) -> DataFrame:
        every = runs[0]
        for run in runs[1:]:
            every = every.unionByName(run)
        return every.groupBy("h").agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """Add the lines of a batch that the runs have not settled yet."""
        fresh = batch
        for run in self.all():
            fresh = fresh.join(run.filter(F.col("n") >= self.settled_at).select("h"), "h", "left_anti")
        carry, level = self._sorted(fresh), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(carry)
            if len(self.levels[level]) < self.fanout:
                return
            old, self.levels[level] = self.levels[level], []
            carry = self._sorted(self.merged(old))
            for run in old:
                discard(run)
            level += 1


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    fanout: int = 2,
) -> DataFrame:
    """*docs* with ``kept_text``, ``n_lines`` and ``n_dropped``.

    A line whose key has *min_chars* code points or more and stands in *min_docs* documents
    or more goes from all of them but the one with the largest *key*. A null or empty text
    is one empty line. Rows with one key are one document; a null key is one document below
    all others. Repeated rows are treated alike. An empty table gives an empty result. The
    names ``__doc``, ``__text``, ``__marks``, ``__d`` and ``__t`` are reserved; the three
    result columns replace columns of those names.
    """
    row = {
        "__doc": F.coalesce(F.col(key).cast("long"), F.lit(_NO_KEY)),
        "__text": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
    }
    narrow = docs.select(*[c.alias(n) for n, c in row.items()], lines_of(F.col(text)).alias("lines"))
    keyed = (
        narrow.select("__doc", "__text", F.posexplode("lines").alias("pos", "line"))
        .filter(F.char_length("line") >= min_chars)
        .select("__doc", "__text", "pos", line_key(F.col("line")).alias("k"))
        .filter(F.char_length("k") >= min_chars)
        .select("__doc", "__text", "pos", F.unhex(F.md5("k")).alias("h"))
    )
    lines = stored(keyed)
    cuts = [i / batches for i in range(1, batches)]
    edges = docs.approxQuantile(key, cuts, 0.01) if batches > 1 else []
    edges = [float("-inf"), *edges, float("inf")]
    runs = Runs(fanout, min_docs)
    for low, high in reversed(list(zip(edges, edges[1:], strict=False))):
        part = lines.filter((F.col("__doc") > low if low != float("-inf") else F.lit(True)) & (F.col("__doc") <= high if high != float("inf") else F.lit(True)))
        counted = part.select("h", "__doc").distinct().groupBy("h")
        runs.add(counted.agg(F.count("*").alias("n"), F.max("__doc").alias("last")))
    common = Runs.merged(runs.all()).filter(F.col("n") >= min_docs).select("h", "last")
    # Marks of a text: one byte per line up to its last dropped line, '1' where it goes.
    marks = (
        lines.join(common, "h")
        .filter("__doc <> last")
        .groupBy(F.col("__doc").alias("__d"), F.col("__text").alias("__t"))
        .agg(F.sort_array(F.collect_set("pos")).alias("at"))
        .select(
            "__d",
            "__t",
            F.array_join(
                F.transform(
                    "at",
                    lambda p, i: F.concat(
                        F.repeat(F.lit("0"), p - F.when(i > 0, F.get("at", i - 1)).otherwise(-1) - 1), F.lit("1")
                    ),
                ),
                "",
            ).cast("binary").alias("__marks"),
            F.size("at").alias("__n"),
        )
    )
    out = docs.drop("kept_text", "n_lines", "n_dropped").withColumns(row)
    joined = out.join(marks, (F.col("__doc") == F.col("__d")) & (F.col("__text") == F.col("__t")), "left")
    lines_now = lines_of(F.col(text))
    stays = F.filter(lines_now, lambda x, i: F.coalesce(F.col("__marks").substr(i + 1, F.lit(1)), F.lit(b"0")) != F.lit(b"1"))
    return joined.select(
        *[c for c in out.columns if c not in row],
        F.when(F.col("__marks").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(stays, "\n")).alias("kept_text"),
        F.size(lines_now).cast("long").alias("n_lines"),
        F.coalesce(F.col("__n").cast("long"), F.lit(0).cast("long")).alias("n_dropped"),
    )
