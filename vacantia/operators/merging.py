"""Merging a run's postings one by one against everything stored so far, as set operations.

A posting's turn stores its content and then looks for the only other live job of its
company with its requisition (and an equal newest title), else for the only one with its
fingerprint; the higher id of the two is folded into the lower. What a turn sees depends on
earlier turns only through which jobs are still live. So the turns are settled as a
fixpoint over the turns at which jobs are folded: each round replays, for every key, births
and deaths of its holders in the order of turns as running sums. The number of live holders
and the sum of their ids tell whether there is exactly one other, and which: no key's holders
are ever listed or paired. Later rounds replay only the keys of jobs whose fate has changed.
The first round starts from the fates that every key would give by itself, so that a long
chain of postings with one key takes one round and not one for each of them. Later
rounds do the same for postings that were expected to meet another one and met none.
"""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.functions.text import comparable_title
from vacantia.operators.identity import latest_titles
from vacantia.session import cut_lineage

KEY = ["company_slug", "kind", "key"]
#: Turns per slice: a hot key is summed slice by slice, in as many tasks.
WIDTH = 50_000


def _live(jobs: DataFrame) -> DataFrame:
    alive = (F.col("status") != "merged") & F.col("merged_into_id").isNull()
    return jobs.filter(alive).select(F.col("id").alias("job_id"), "company_slug")


def _keys(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per key of a row; a null key is none."""
    each = F.array(
        *[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("key")) for kind, c in (("requisition", "requisition_id"), ("fingerprint", "fingerprint"))]
    )
    return rows.select(*columns, F.explode(each).alias("_k")).select(*columns, "_k.kind", "_k.key").filter("key is not null")


def key_index(jobs: DataFrame, contents: DataFrame) -> DataFrame:
    """(company_slug, kind, key, job_id): the live jobs that hold each key in any stored content."""
    keyed = _keys(contents.select("job_id", "requisition_id", "fingerprint"), "job_id")
    return keyed.join(_live(jobs), "job_id").select(*KEY, "job_id").distinct()


def grown_index(index: DataFrame, jobs: DataFrame, arrivals: DataFrame, merges: DataFrame) -> DataFrame:
    """The index after a run: keys of the postings that had their turn are added, folded jobs leave.

    *merges* is what :func:`fold_run` has returned for the same arrivals. Only rows of the
    run and of folded jobs are touched; nothing is counted anew from stored contents.
    """
    folded = merges.select("job_id", F.col("turn").alias("_died"))
    stored = (
        arrivals.join(_live(jobs), "job_id")
        .join(folded, "job_id", "left")
        .filter("_died is null")
    )
    kept = index.join(folded.select("job_id"), "job_id", "left_anti").select(*KEY, "job_id")
    return kept.unionByName(_keys(stored, "company_slug", "job_id").select(*KEY, "job_id")).distinct()


def _running(events: DataFrame, order: list[str], width: int, **values: tuple) -> DataFrame:
    """Each question with its *values* over the events of its key before it in the order of turns.

    A value is a column, its aggregate and how two of them are put together. Aggregates run
    within (key, slice of turns) and over the totals of earlier slices.
    """
    sliced = events.withColumn("_slice", F.expr(f"turn div {width}"))
    inner = Window.partitionBy(*KEY, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*KEY).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(*KEY, "_slice").agg(*[agg(c).alias(v) for v, (c, agg, _) in values.items()])
    before = totals.select(*KEY, "_slice", *[agg(v).over(outer).alias(f"_{v}0") for v, (_, agg, _) in values.items()])
    asked = [c for c in events.columns if c not in KEY and c not in values]
    running = sliced.select(*KEY, "_slice", *asked, *[agg(c).over(inner).alias(f"_{v}") for v, (c, agg, _) in values.items()])
    return (
        running.filter("asker is not null")
        .join(before, [*KEY, "_slice"])
        .select(*KEY, *asked, *[both(F.col(f"_{v}0"), F.col(f"_{v}")).alias(v) for v, (_, _, both) in values.items()])
    )


def _plus(one: Column, other: Column) -> Column:
    return F.coalesce(one, F.lit(0)) + F.coalesce(other, F.lit(0))


def _state(events: DataFrame, width: int) -> DataFrame:
    """(key, asker, n, ids): live holders and the sum of their ids just before each question."""
    return _running(events, ["turn", "phase"], width, n=("n", F.sum, _plus), ids=("ids", F.sum, _plus))


def _edges(matches: DataFrame) -> DataFrame:
    """(job_id, turn, folded, into, matched_by) of postings and their matches.

    Another's work in progress is not folded by this run; its own postings are.
    """
    return matches.select(
        "job_id", "turn", F.greatest("job_id", "match").alias("folded"), F.least("job_id", "match").alias("into"), "matched_by", "busy"
    ).filter("folded = job_id or not busy").drop("busy")


def _fates(decided: DataFrame) -> DataFrame:
    """(job_id, died, into, matched_by): the first turn at which each job is folded."""
    return (
        decided.groupBy(F.col("folded").alias("job_id"))
        .agg(F.min(F.struct(F.col("turn").alias("died"), "into", "matched_by")).alias("_d"))
        .select("job_id", "_d.*")
    )


def _guessed(holders: DataFrame, facts: DataFrame, width: int) -> DataFrame:
    """The edges if every key stood alone: a chain of postings with one key is folded into
    the lowest id so far. The rounds start from here and put right what is not so."""
    none = F.lit(None).cast("long")
    event = lambda turn, n, title, asker: F.struct(
        turn.alias("turn"), F.lit(n).cast("long").alias("n"), F.when(F.col("kind") == "requisition", title).alias("title"), asker.alias("asker")
    )
    stored = F.when(F.col("since") == 0, event(F.col("since"), 1, F.col("old_title"), none))
    asks = F.when(F.col("asks").isNotNull(), event(F.col("asks"), 0, F.col("new_title"), F.col("job_id")))
    named = holders.join(facts.select("job_id", "old_title", "new_title"), "job_id")
    events = named.select(
        *KEY, F.col("job_id").alias("id"), (F.col("since") == 0).alias("own"), F.explode(F.array_compact(F.array(stored, asks))).alias("_e")
    )
    seen = _running(
        cut_lineage(events.select(*KEY, "id", "own", "_e.*")),
        ["turn"],
        width,
        n=("n", F.sum, _plus),
        low=("id", F.min, F.least),
        first=("title", F.min, F.least),
        last=("title", F.max, F.greatest),
    ).withColumnRenamed("asker", "job_id")
    alone = (F.col("low") != F.col("job_id")) & ((F.col("n") < 2) | ((F.col("n") == 2) & F.col("own")))
    agreed = (F.col("first") == F.col("title")) & (F.col("last") == F.col("title"))
    found = seen.filter(alone & (agreed | (F.col("kind") == "fingerprint"))).groupBy("job_id", "turn")
    # By name a requisition comes after a fingerprint, so the maximum is the one that counts.
    best = found.agg(F.max(F.struct(F.col("kind").alias("matched_by"), F.col("low").alias("match"))).alias("_b")).select("job_id", "turn", "_b.*")
    return _edges(best.join(facts.select(F.col("job_id").alias("match"), "busy"), "match"))


def _decided(affected: DataFrame, holders: DataFrame, deaths: DataFrame, facts: DataFrame, width: int) -> DataFrame:
    """(job_id, turn, folded, into, matched_by) of each affected posting, given when jobs are folded.

    A posting that meets nobody by a key has a row with that key's kind in *alone* and no *folded*.
    """
    asked = _keys(affected, "company_slug", "job_id", "turn")
    held = holders.join(asked.select(*KEY).distinct(), KEY, "left_semi").join(deaths.select("job_id", "died"), "job_id", "left")
    # A posting that is folded before its turn never stores its content.
    held = held.filter((F.col("since") == 0) | F.col("died").isNull() | (F.col("died") >= F.col("since")))
    number = F.col("job_id").cast("decimal(38,0)")
    none = F.lit(None).cast("long").alias("asker")
    event = lambda turn, phase, n, ids: F.struct(
        F.col(turn).alias("turn"), F.lit(phase).alias("phase"), F.lit(n).alias("n"), ids.cast("decimal(38,0)").alias("ids")
    )
    both = held.select(*KEY, F.explode(F.array(event("since", 0, 1, number), event("died", 2, -1, -number))).alias("_e"))
    stays = both.select(*KEY, "_e.*").filter("phase = 0 or turn is not null").groupBy(*KEY, "turn", "phase")
    stays = stays.agg(F.sum("n").cast("long").alias("n"), F.sum("ids").cast("decimal(38,0)").alias("ids"))
    turns = asked.join(deaths.select("job_id", "died"), "job_id", "left").filter("died is null or died >= turn")
    turns = turns.select(
        *KEY, "turn", F.lit(1).alias("phase"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias("ids"), F.col("job_id").alias("asker")
    )
    # Events are read twice: once as they are and once as totals of slices.
    events = cut_lineage(stays.withColumn("asker", none).unionByName(turns))
    # Who meets nobody and who meets one are asked of the same rows: a large part is never summed twice.
    seen = cut_lineage(_state(events, width).filter("n <= 2").withColumnRenamed("asker", "job_id"))
    # The asker itself holds the key by now.
    none = F.lit(None).cast("long")
    alone = seen.filter("n = 1").select("job_id", "turn", none.alias("folded"), none.alias("into"), F.lit(None).cast("string").alias("matched_by"), F.col("kind").alias("alone"))
    only = seen.filter("n = 2").select("job_id", F.col("turn").alias("asked"), "kind", (F.col("ids") - F.col("job_id")).cast("long").alias("match"))
    asker = affected.select("job_id", F.col("new_title").alias("title"))
    other = facts.withColumnRenamed("job_id", "match").join(deaths.select(F.col("job_id").alias("match"), "died"), "match", "left")
    turned = (F.col("turn") < F.col("asked")) & (F.col("died").isNull() | (F.col("died") >= F.col("turn")))
    other_title = F.when(F.coalesce(turned, F.lit(False)), F.col("new_title")).otherwise(F.col("old_title"))
    agreed = (F.col("kind") == "fingerprint") | (F.col("title") == other_title)
    found = only.join(asker, "job_id").join(other, "match").filter(agreed).groupBy("job_id", F.col("asked").alias("turn"))
    # By name a requisition comes after a fingerprint, so the maximum is the one that counts.
    best = found.agg(F.max(F.struct(F.col("kind").alias("matched_by"), "match", "busy")).alias("_b"))
    return _edges(best.select("job_id", "turn", "_b.*")).withColumn("alone", F.lit(None).cast("string")).unionByName(alone)


def _changed(after: DataFrame, before: DataFrame) -> DataFrame:
    """The jobs whose fates differ: these stand once among both, equal ones twice."""
    each = after.unionByName(before).groupBy("job_id", "died", "into", "matched_by").agg(F.count("*").alias("n"))
    return each.filter("n = 1").select("job_id").distinct()


def fold_run(jobs: DataFrame, contents: DataFrame, arrivals: DataFrame, index: DataFrame | None = None, width: int = WIDTH) -> DataFrame:
    """(job_id, canonical_id, matched_by, turn): the merges of a run over stored contents.

    *jobs* and *contents* are the tables before the run; *arrivals* has one row per posting
    of the run: job_id, requisition_id, title, fingerprint and turn (1, 2, ..., all
    different). Arrivals of jobs that are not live are left out. A posting that is folded
    before its turn has none. The result is that of working through the turns one by one:
    only live jobs of the same company count, in any of their stored contents and in those
    of earlier turns; titles are those of a job's newest content at that time, a null title
    agrees with none; jobs in progress that are not among the arrivals are never folded.
    *index* is :func:`key_index` of the tables, made if it is not given; it is read for the
    keys of the arrivals only. Rounds are as many as the longest chain of turns that depend
    on each other across keys, where the keys' own chains do not foretell them.
    """
    index = key_index(jobs, contents) if index is None else index
    title = comparable_title("title")
    given = arrivals.select("job_id", "requisition_id", "fingerprint", F.col("turn").cast("long").alias("turn"), title.alias("new_title"))
    arrived = cut_lineage(given.join(_live(jobs), "job_id"))
    asked = _keys(arrived, "company_slug", "job_id", "turn")
    known = index.join(asked.select(*KEY).distinct(), KEY, "left_semi").select(
        *KEY, "job_id", F.lit(0).cast("long").alias("since"), F.lit(None).cast("long").alias("asks")
    )
    holders = known.unionByName(asked.select(*KEY, "job_id", F.col("turn").alias("since"), F.col("turn").alias("asks")))
    holders = cut_lineage(holders.groupBy(*KEY, "job_id").agg(F.min("since").alias("since"), F.max("asks").alias("asks")))
    ids = holders.select("job_id").distinct()
    named = contents.select("id", "job_id", "title").join(ids, "job_id", "left_semi")
    busy = jobs.filter("status = 'in_progress'").select(F.col("id").alias("job_id")).distinct().join(arrived, "job_id", "left_anti")
    # What every round asks of a job, put together once.
    facts = cut_lineage(
        ids.join(latest_titles(named).withColumnRenamed("latest_title", "old_title"), "job_id", "left")
        .join(arrived.select("job_id", "new_title", "turn"), "job_id", "left")
        .join(busy.withColumn("busy", F.lit(True)), "job_id", "left")
        .withColumn("busy", F.col("busy").isNotNull())
    )
    # Whatever the rounds start from, they end in the same fates: those of turn 1 hang on none.
    edges = cut_lineage(_guessed(holders, facts, width))
    deaths = cut_lineage(_fates(edges))
    decided, affected = None, arrived
    while True:
        new = _decided(affected, holders, deaths, facts, width)
        if decided is not None:
            new = decided.join(affected.select("job_id"), "job_id", "left_anti").unionByName(new)
        decided = cut_lineage(new)
        found = decided.filter("folded is not null").drop("alone")
        after = cut_lineage(_fates(found))
        if _changed(after, deaths).isEmpty():
            return after.select("job_id", F.col("into").alias("canonical_id"), "matched_by", F.col("died").alias("turn"))
        # Postings that were to meet another one by a key and met nobody: by themselves they
        # are a chain again, of which the first one stays. Only turns after it are foretold.
        lost = edges.join(found.select("job_id"), "job_id", "left_anti").select("job_id", F.col("matched_by").alias("kind"))
        lost = lost.join(decided.select("job_id", F.col("alone").alias("kind")), ["job_id", "kind"], "left_semi")
        chained = holders.join(lost, ["job_id", "kind"], "left_semi").withColumn("since", F.col("asks"))
        edges = cut_lineage(found.unionByName(_guessed(chained, facts, width)))
        expected = cut_lineage(_fates(edges))
        keys = holders.join(_changed(expected, deaths), "job_id", "left_semi").select(*KEY).distinct()
        again = asked.join(keys, KEY, "left_semi").select("job_id").distinct()
        affected = cut_lineage(arrived.join(again, "job_id", "left_semi"))
        deaths = expected
        # Proxies of JVM objects stand in reference cycles, which Python seldom looks for; until
        # then the driver keeps the plans of all earlier rounds.
        gc.collect()
