"""Extracted facts: quotes, state rules, cross-field rules, technologies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import text as tx
from vacantia.schemas import (
    EMPLOYMENT_TYPES,
    EXPERIENCE_LEVELS,
    FACT_VALUES,
    FACTS,
    JOB_FUNCTIONS,
    MODEL_STATES,
    QUALIFICATION_KINDS,
    TECHNOLOGY_STATUSES,
    WORK_MODES,
)
from vacantia.session import small_side

FACT_NAMES = tuple(FACT_VALUES)
# Facts whose list items carry quotes of their own.
NESTED = ("required_qualifications", "preferred_qualifications", "technologies")
CODED = {
    "work_mode": WORK_MODES,
    "employment_type": EMPLOYMENT_TYPES,
    "experience_level": EXPERIENCE_LEVELS,
}
# Technologies with their spellings and kind.
TECHNOLOGIES = (
    ("JavaScript", "language", ("javascript", "js")),
    ("TypeScript", "language", ("typescript", "ts")),
    ("Python", "language", ("python",)),
    ("C#", "language", ("c#", "c sharp")),
    ("Go", "language", ("go", "golang")),
    ("React", "framework", ("react", "reactjs", "react.js", "react js")),
    ("Angular", "framework", ("angular",)),
    ("AngularJS", "framework", ("angularjs", "angular.js")),
    ("Vue", "framework", ("vue", "vuejs", "vue.js")),
    ("Node.js", "runtime", ("node.js", "nodejs", "node")),
    (".NET", "framework", (".net", ".net core", ".net framework")),
    ("Django", "framework", ("django", "django rest framework")),
    ("Spring", "framework", ("spring", "spring boot", "spring framework")),
    ("TensorFlow", "library", ("tensorflow",)),
    ("PyTorch", "library", ("pytorch",)),
    ("scikit-learn", "library", ("scikit-learn", "sklearn")),
    ("spaCy", "library", ("spacy",)),
    ("SQL", "concept", ("sql",)),
    ("NoSQL", "concept", ("nosql",)),
    ("PostgreSQL", "database", ("postgresql", "postgres", "pg")),
    ("MySQL", "database", ("mysql",)),
    ("Microsoft SQL Server", "database", ("microsoft sql server", "mssql", "sql server")),
    ("SQLite", "database", ("sqlite",)),
    ("MongoDB", "database", ("mongodb", "mongo")),
    ("Azure Cosmos DB", "database", ("azure cosmos db", "cosmos db", "cosmos")),
    ("Amazon Web Services", "cloud", ("amazon web services", "aws")),
    ("Microsoft Azure", "cloud", ("microsoft azure", "azure")),
    ("Google Cloud Platform", "cloud", ("google cloud platform", "google cloud", "gcp")),
    ("Azure DevOps", "platform", ("azure devops",)),
    ("Docker", "tool", ("docker",)),
    ("Kubernetes", "platform", ("kubernetes", "k8s")),
    ("Terraform", "tool", ("terraform",)),
    ("Git", "tool", ("git",)),
    ("GitHub", "platform", ("github",)),
    ("ELK", "platform", ("elk", "elk stack")),
    ("REST", "concept", ("rest", "restful")),
    ("CI/CD", "concept", ("ci/cd", "continuous integration/continuous deployment")),
)


def technology_aliases(spark) -> DataFrame:
    """One row per spelling: alias, canonical, kind."""
    rows = [(alias, name, kind) for name, kind, aliases in TECHNOLOGIES for alias in aliases]
    return spark.createDataFrame(rows, "alias string, canonical string, kind string")


def resolve_technologies(mentions: DataFrame, mention: str = "mention") -> DataFrame:
    """Join mentions to the dictionary: adds canonical, kind and the grouping key.

    The dictionary is a fixed list of some seventy rows, hence broadcast. Mentions it
    does not know group under ``raw:`` and their folded spelling.
    """
    keyed = mentions.withColumn("alias", tx.technology_key(mention)).withColumn(
        "_raw", F.concat(F.lit("raw:"), tx.fold(mention))
    )
    aliases = F.broadcast(technology_aliases(mentions.sparkSession))
    return (
        keyed.join(aliases, "alias", "left")
        .withColumn("technology", F.coalesce("canonical", "_raw"))
        .drop("_raw", "alias")
    )


def status_rank(status: Column) -> Column:
    return F.array_position(tx.fixed_strings(TECHNOLOGY_STATUSES), status)


def group_technologies(mentions: DataFrame, key: str = "job_id", order: str = "ord") -> DataFrame:
    """Technologies of each job: highest status, number of mentions, mentions in order.

    The mentions of a job come from one answer, so the list per group is short.
    """
    resolved = resolve_technologies(mentions)
    return resolved.groupBy(key, "technology").agg(
        F.first("canonical").alias("canonical"),
        F.first("kind").alias("kind"),
        F.element_at(
            tx.fixed_strings(TECHNOLOGY_STATUSES), F.max(status_rank(F.col("status"))).cast("int")
        ).alias("status"),
        F.min(order).alias("first_place"),
        F.transform(
            F.sort_array(F.collect_list(F.struct(order, "mention"))), lambda m: m["mention"]
        ).alias("mentions"),
    )


def fact_quotes(results: DataFrame, keys: list[str], facts: str = "facts") -> DataFrame:
    """Every quote of each result: keys, field, nested place, position, path, quote."""
    lists = []
    for name in FACT_NAMES:
        own = F.transform(F.col(facts)[name]["evidence"], _own_quote(name))
        lists.append(F.coalesce(own, F.array().cast(_QUOTES)))
        if name in NESTED:
            nested = F.flatten(F.transform(F.col(facts)[name]["value"], _nested_quotes(name)))
            lists.append(F.coalesce(nested, F.array().cast(_QUOTES)))
    return results.select(*keys, F.explode_outer(F.concat(*lists)).alias("_q")).filter("_q is not null").select(*keys, "_q.*")


_QUOTES = "array<struct<field:string,item:int,position:int,path:string,quote:string>>"


def _own_quote(name: str):
    return lambda quote, i: F.struct(
        F.lit(name).alias("field"),
        F.lit(-1).alias("item"),
        i.alias("position"),
        F.concat(F.lit(f"$.{name}.evidence["), i.cast("string"), F.lit("]")).alias("path"),
        quote.alias("quote"),
    )


def _nested_quotes(name: str):
    def of_item(item: Column, n: Column) -> Column:
        return F.transform(
            item["evidence"],
            lambda quote, i: F.struct(
                F.lit(name).alias("field"),
                n.alias("item"),
                i.alias("position"),
                F.concat(
                    F.lit(f"$.{name}.value["),
                    n.cast("string"),
                    F.lit("].evidence["),
                    i.cast("string"),
                    F.lit("]"),
                ).alias("path"),
                quote.alias("quote"),
            ),
        )

    return of_item


def failed_fields(results: DataFrame, keys: list[str], facts: str = "facts") -> DataFrame:
    """Paths of the facts whose state is ``failed``."""
    states = F.array(
        *[
            F.when(F.col(facts)[name]["state"] == "failed", F.lit(f"$.{name}.state"))
            for name in FACT_NAMES
        ]
    )
    return results.select(*keys, F.explode(F.array_compact(states)).alias("failed_field")).distinct()


def _blank(values: Column) -> Column:
    return F.coalesce(F.exists(values, lambda v: ~v.rlike(r"\S")), F.lit(False))


def fact_violations(results: DataFrame, keys: list[str], facts: str = "facts") -> DataFrame:
    """Broken state, code and blank rules of facts: keys, field, rule."""
    flags = []
    for name in FACT_NAMES:
        fact = F.col(facts)[name]
        state, value, quotes = fact["state"], fact["value"], fact["evidence"]
        cited = F.coalesce(F.size(quotes), F.lit(0)) > 0
        rules = [
            (~state.isin(*MODEL_STATES, "failed"), "state_unknown"),
            ((state == "extracted") & (value.isNull() | ~cited), "extracted_incomplete"),
            ((state == "not_stated") & (value.isNotNull() | cited), "not_stated_filled"),
            ((state == "uncertain") & ~cited, "uncertain_uncited"),
            ((state == "failed") & (value.isNotNull() | cited), "failed_filled"),
            (_blank(quotes), "quote_blank"),
        ]
        if name in CODED:
            rules.append((value.isNotNull() & ~value.isin(*CODED[name]), "value_unknown"))
        if name == "job_functions":
            rules.append(
                (F.exists(value, lambda v: ~v.isin(*JOB_FUNCTIONS)), "value_unknown")
            )
        if name == "source_language":
            rules.append(
                (value.isNotNull() & ~value.rlike(r"\A[a-z]{2}\z"), "language_code")
            )
        if name == "location":
            rules.append((value.isNotNull() & ~value["country"].rlike(r"\S"), "country_blank"))
        if name in NESTED:
            label = "mention" if name == "technologies" else "text"
            code, allowed = ("status", TECHNOLOGY_STATUSES) if name == "technologies" else ("kind", QUALIFICATION_KINDS)
            rules += [
                (F.exists(value, _item_blank(label)), f"{label}_blank"),
                (F.exists(value, _item_not_in(code, allowed)), f"{code}_unknown"),
                (F.exists(value, _item_unquoted()), "item_unquoted"),
            ]
        for broken, rule in rules:
            flags.append(
                F.when(
                    F.coalesce(broken, F.lit(False)),
                    F.struct(F.lit(name).alias("field"), F.lit(rule).alias("rule")),
                )
            )
    return results.select(*keys, F.explode(F.array_compact(F.array(*flags))).alias("_v")).select(
        *keys, "_v.*"
    )


def _item_blank(label: str):
    return lambda item: ~item[label].rlike(r"\S")


def _item_not_in(code: str, allowed):
    return lambda item: ~item[code].isin(*allowed)


def _item_unquoted():
    return lambda item: (F.coalesce(F.size(item["evidence"]), F.lit(0)) == 0) | _blank(item["evidence"])


def _tagged(name: str):
    return lambda quote: F.struct(F.lit(name).alias("fact"), quote.alias("q"))


def _of_fact(pairs: str, name: str) -> Column:
    return F.filter(pairs, lambda c: c["fact"] == name)


def validate_facts(results: DataFrame, contents: DataFrame, key: str = "content_id") -> DataFrame:
    """Cross-field rules over extracted facts: one row per result.

    *results*: key columns incl. *key*, and *facts*; *contents*: key, text. Adds *rejected*
    (the answer must not be stored), *ungrounded* quotes of rejected answers, the adjusted
    *facts* and the *notes*. Documents are folded once and joined by key; each result is
    then judged inside its own row.
    """
    cited = contents.join(small_side(results.select(key).distinct()), key, "left_semi")
    docs = cited.select(key, "text", tx.folded_text("text").alias("_folded"))
    # Generated columns: plain ones would be copied into each of their many uses.
    df = tx.computed(results.join(docs, key, "left"), "_post", tx.collapse(F.col("_folded")))
    facts = F.col("facts")
    # All strings to be searched stand in one array, tagged with their fact, and are folded at once.
    none = F.array().cast("array<string>")
    tagged = []
    for name in FACT_NAMES:
        quotes = F.coalesce(facts[name]["evidence"], none)
        if name in NESTED:
            own = F.flatten(F.transform(facts[name]["value"], lambda v: v["evidence"]))
            quotes = F.concat(quotes, F.coalesce(own, none))
        tagged.append(F.transform(quotes, _tagged(name)))
    df = df.withColumn("_cited", F.concat(*tagged))
    df = df.withColumn("_keys", tx.grounding_texts(F.transform("_cited", lambda c: c["q"])))
    pair = lambda c, k: F.struct(c["fact"].alias("fact"), c["q"].alias("q"), k.alias("k"))
    df = df.withColumn("_cited", F.zip_with("_cited", "_keys", pair)).drop("_keys")
    df = tx.computed(
        df, "_missed", F.filter("_cited", lambda c: ~F.coalesce(F.contains(F.col("_post"), c["k"]), F.lit(False)))
    )
    df = df.withColumns({f"_u_{n}": F.transform(_of_fact("_missed", n), lambda c: c["q"]) for n in FACT_NAMES})

    def was_extracted(name: str) -> Column:
        return F.coalesce(facts[name]["state"] == "extracted", F.lit(False))

    def lost(name: str) -> Column:
        return F.size(F.col(f"_u_{name}")) > 0

    extracted = sum((was_extracted(n).cast("int") for n in FACT_NAMES[1:]), was_extracted(FACT_NAMES[0]).cast("int"))
    failed = sum(
        ((was_extracted(n) & lost(n)).cast("int") for n in FACT_NAMES[1:]),
        (was_extracted(FACT_NAMES[0]) & lost(FACT_NAMES[0])).cast("int"),
    )
    title_failed = lost("title") | F.coalesce(facts["title"]["state"] == "failed", F.lit(False))
    df = df.withColumn("_extracted", extracted).withColumn("_failed", failed)
    df = df.withColumn(
        "rejected",
        title_failed | ((F.col("_extracted") > 0) & (F.col("_failed") * 3 > F.col("_extracted"))),
    ).withColumn(
        "ungrounded",
        F.when(
            F.col("rejected"),
            F.flatten(
                F.array(
                    *[
                        F.when(was_extracted(n), F.col(f"_u_{n}")).otherwise(F.array().cast("array<string>"))
                        for n in FACT_NAMES
                    ]
                )
            ),
        ),
    )
    notes = [
        F.transform(F.col(f"_u_{n}"), _ungrounded_note(n)) for n in FACT_NAMES
    ]
    # State after grounding.
    state = {n: F.when(lost(n), "failed").otherwise(facts[n]["state"]) for n in FACT_NAMES}
    value = {n: F.when(~lost(n), facts[n]["value"]) for n in FACT_NAMES}
    quotes = {
        n: F.when(lost(n), F.array().cast("array<string>")).otherwise(facts[n]["evidence"]) for n in FACT_NAMES
    }
    # Location needs its text.
    df = df.withColumn(
        "_no_text", (state["location"] == "extracted") & (state["location_text"] != "extracted")
    )
    # Preferred items that repeat a required one.
    df = df.withColumn(
        "_req", F.coalesce(F.transform(value["required_qualifications"], lambda v: v["text"]), F.array().cast("array<string>"))
    ).withColumn(
        "_pref", F.coalesce(F.transform(value["preferred_qualifications"], lambda v: v["text"]), F.array().cast("array<string>"))
    )
    df = df.withColumn("_req_k", tx.grounding_texts("_req")).withColumn("_pref_k", tx.grounding_texts("_pref"))
    df = df.withColumn(
        "_repeated",
        F.transform(
            F.filter(
                F.arrays_zip(F.col("_pref").alias("t"), F.col("_pref_k").alias("k")),
                lambda z: F.array_contains(F.col("_req_k"), z["k"]),
            ),
            lambda z: z["t"],
        ),
    )
    # Names in the summary that the posting does not hold.
    df = df.withColumn(
        "_nouns",
        F.when(
            (state["summary"] == "extracted") & value["summary"].isNotNull(),
            tx.proper_nouns(value["summary"]),
        ).otherwise(F.array().cast("array<string>")),
    ).withColumn("_absent", F.filter("_nouns", lambda n: ~F.contains(F.col("_post"), F.lower(n))))
    # Required technologies need a trace: a required quote, a cue or a required section.
    # Only answers with technology quotes need the posting's sections.
    df = df.withColumn(
        "_lines", F.when(F.size(_of_fact("_cited", "technologies")) > 0, tx.section_lines("text", "_folded"))
    )
    df = df.withColumn(
        "_req_quotes",
        F.coalesce(
            F.flatten(F.transform(value["required_qualifications"], lambda v: v["evidence"])),
            F.array().cast("array<string>"),
        ),
    ).withColumn("_req_quotes_k", tx.grounding_texts("_req_quotes"))
    own = F.size(F.coalesce(facts["technologies"]["evidence"], F.array().cast("array<string>")))
    df = df.withColumn("_own", own)

    def trace(quote: Column, quote_key: Column) -> Column:
        return (
            F.array_contains(F.col("_req_quotes_k"), quote_key)
            | quote.rlike(tx.REQUIRED_CUE)
            | tx.in_required_section(quote_key, F.col("_lines"))
        )

    keyed_quotes = _of_fact("_cited", "technologies")
    df = df.withColumn("_traced", F.transform(keyed_quotes, lambda z: trace(z["q"], z["k"])))
    # Quotes of mention n start after the fact's own quotes and those of earlier mentions.
    mentions = value["technologies"]
    starts = F.transform(
        mentions,
        lambda m, n: F.aggregate(
            F.slice(mentions, F.lit(1), n), F.col("_own"), lambda acc, e: acc + F.size(e["evidence"])
        ),
    )
    df = df.withColumn("_starts", starts).withColumn("_mentions", mentions)
    lowered = F.transform(
        F.col("_mentions"),
        lambda m, n: (m["status"] == "required")
        & ~F.coalesce(
            F.exists(
                F.slice(F.col("_traced"), F.element_at(F.col("_starts"), n + 1) + 1, F.size(m["evidence"])),
                lambda hit: hit,
            ),
            F.lit(False),
        ),
    )
    df = df.withColumn("_lowered", lowered)
    adjusted = F.transform(
        F.col("_mentions"),
        lambda m, n: F.struct(
            m["mention"].alias("mention"),
            F.when(F.element_at(F.col("_lowered"), n + 1), "mentioned").otherwise(m["status"]).alias("status"),
            m["evidence"].alias("evidence"),
        ),
    )
    repeated = F.size("_repeated") > 0
    none = F.array().cast("array<string>")
    state["location"] = F.when(F.col("_no_text"), "failed").otherwise(state["location"])
    value["location"] = F.when(~F.col("_no_text"), value["location"])
    quotes["location"] = F.when(F.col("_no_text"), none).otherwise(quotes["location"])
    name = "preferred_qualifications"
    state[name] = F.when(repeated, "failed").otherwise(state[name])
    value[name] = F.when(~repeated, value[name])
    quotes[name] = F.when(repeated, none).otherwise(quotes[name])
    state["summary"] = F.when(F.size("_absent") > 0, "uncertain").otherwise(state["summary"])
    value["technologies"] = adjusted
    new_facts = F.struct(
        *[
            F.struct(
                state[n].alias("state"), value[n].alias("value"), quotes[n].alias("evidence")
            )
            .cast(FACTS[n].dataType)
            .alias(n)
            for n in FACT_NAMES
        ]
    )
    one = lambda condition, note: F.when(condition, F.array(note)).otherwise(none)
    notes += [
        one(F.col("_no_text"), F.lit("location: extracted location requires extracted location_text")),
        one(
            repeated,
            F.concat(
                F.lit("preferred_qualifications: duplicates required qualification: "),
                F.array_join("_repeated", ", "),
            ),
        ),
        one(
            F.size("_absent") > 0,
            F.concat(F.lit("summary: proper nouns absent from posting: "), F.array_join("_absent", ", ")),
        ),
        F.coalesce(
            F.transform(
                F.filter(
                    F.arrays_zip(F.col("_mentions").alias("m"), F.col("_lowered").alias("l")), lambda z: z["l"]
                ),
                lambda z: F.concat(
                    F.lit("technologies: lowered "), z["m"]["mention"], F.lit(" from required to mentioned")
                ),
            ),
            none,
        ),
    ]
    keep = [c for c in results.columns if c != "facts"]
    return df.select(
        *keep,
        "rejected",
        "ungrounded",
        F.when(~F.col("rejected"), new_facts).alias("facts"),
        F.when(~F.col("rejected"), F.flatten(F.array(*notes))).alias("notes"),
    )


def _ungrounded_note(name: str):
    return lambda quote: F.concat(F.lit(f'{name}: ungrounded evidence "'), quote, F.lit('"'))
