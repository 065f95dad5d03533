"""Record linkage: candidates, scores, decisions and the log of ambiguous matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .ordering import best_and_margin


def exact_matches(sources: DataFrame, happenings: DataFrame) -> DataFrame:
    """source_happening_id, happening_id and rule: by external id, else by fingerprint. Archived happenings never match.

    sources: id, source_id, external_id, dedupe_key. happenings: id, source_id, external_id, dedupe_key, status.
    """
    live = happenings.filter(F.coalesce(F.col("status"), F.lit("")) != "archived")
    right = live.select(F.col("id").alias("happening_id"), F.col("source_id").alias("_s"), F.col("external_id").alias("_e"), F.col("dedupe_key").alias("_d"))
    by_id = sources.join(right, (F.col("source_id") == F.col("_s")) & (F.col("external_id") == F.col("_e")))
    found = by_id.select(F.col("id").alias("source_happening_id"), "happening_id", F.lit("external_id").alias("rule"))
    rest = sources.join(found.select(F.col("source_happening_id").alias("_id")).distinct(), F.col("id") == F.col("_id"), "left_anti")
    by_key = rest.join(right, F.col("dedupe_key") == F.col("_d")).select(F.col("id").alias("source_happening_id"), "happening_id", F.lit("fingerprint").alias("rule"))
    return found.unionByName(by_key)


def _word_keys(words: Column) -> Column:
    """A sorted array of longs for an array of distinct words: long words first, as these are rarer, and then by hash."""
    return F.sort_array(F.transform(words, lambda w: F.shiftleft(63 - F.least(F.length(w), F.lit(63)).cast("bigint"), 56) + F.xxhash64(w).bitwiseAND(F.lit((1 << 56) - 1))))


def _prefix(keys: Column, similarity: float) -> Column:
    """The keys of which two word sets of that Jaccard likeness or more share one; an empty set has the key 0."""
    n = F.size(keys)
    most = (n - F.ceil(similarity * n - F.lit(1e-9)) + 1).cast("int")
    return F.when(n == 0, F.array(F.lit(0).cast("bigint"))).otherwise(F.slice(keys, 1, F.least(F.greatest(most, F.lit(1)), n)))


#: Ids that a row of equal titles, dates and venues holds, about; more are dealt to several rows.
GROUP = 1024


#: Parts into which the rows of one key are dealt where they meet many.
SALTS = 8


def _shared(x: str, y: str) -> Column:
    """The number of members that two array columns share. Being undeterministic by name, it is found once a row: copied into
    each filter and column that uses it, it made methods too large to be compiled."""
    return F.size(F.array_intersect(x, y)) + F.spark_partition_id() * 0


def _likeness(both: Column, x: Column, y: Column) -> Column:
    """As T.likeness, by the number of words that both have and that each has."""
    return F.when((x == 0) & (y == 0), F.lit(1.0)).when((x == 0) | (y == 0), F.lit(0.0)).otherwise(both.cast("double") / (x + y - both))


def _spread(left: DataFrame, right: DataFrame, on: list[str], by: list[str]) -> DataFrame:
    """An inner join for small tables that give many rows: each key's left rows are dealt by `by` to SALTS tasks, and parts aren't joined up again for being small."""
    parts = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), left.sparkSession.sparkContext.defaultParallelism)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keys = [*on, "_salt"]
    return salted.repartition(parts, *keys).join(copies.repartition(parts, *keys), keys).drop("_salt")


def _groups(df: DataFrame, p: str) -> DataFrame:
    """Rows (id, title, start_date, venue) by equal title, date and venue, with their `ids`; words are found once a group.

    Adds `{p}_words` and `{p}_place` and their hashes `{p}_w` and `{p}_v`, by which groups meet.
    """
    by = ["title", "start_date", "venue"]
    rows = df.select("id", *by)
    many = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("_parts")).filter("_parts > 1").toDF("_title", "_date", "_venue", "_parts")
    dealt = rows.join(many, F.col("title").eqNullSafe(F.col("_title")) & F.col("start_date").eqNullSafe(F.col("_date")) & F.col("venue").eqNullSafe(F.col("_venue")), "left")
    part = F.coalesce(F.pmod(F.xxhash64("id"), F.col("_parts")), F.lit(0))
    held = dealt.groupBy(*by, part.alias("_part")).agg(F.collect_list(F.struct("id")).alias(f"{p}_ids"))
    words = held.select(
        F.col("title").alias(f"{p}_title"), F.col("start_date").alias(f"{p}_date"), f"{p}_ids", _word_keys(T.tokens(T.normalize_title(F.col("title")))).alias(f"{p}_words"), _word_keys(T.tokens(T.normalize_venue(F.col("venue")))).alias(f"{p}_place")
    )
    return words.withColumn(f"{p}_w", F.xxhash64(f"{p}_words")).withColumn(f"{p}_v", F.xxhash64(f"{p}_place"))


def _keys(p: str, same_day: bool) -> list[str]:
    return [f"{p}_w", f"{p}_v"] + [f"{p}_date"] * same_day


def _scored(a: DataFrame, b: DataFrame, floor: float, same_day: bool) -> DataFrame:
    """The `_keys` of both sides and the score, from `floor` on, of groups of one day or, without the date, of those of any days.

    First titles meet, each pair once, then the venues of the titles that are alike enough.
    """
    day, similarity = (0.3, 2 * floor - 1) if same_day else (0.0, 2 * floor - 0.4)

    def titles(df: DataFrame, p: str) -> DataFrame:
        own = df.select(*[f"{p}_date"] * same_day, f"{p}_w", f"{p}_words").distinct().withColumn(f"{p}_prefix", _prefix(F.col(f"{p}_words"), similarity))
        # a prefix has a word at least; of a plain explode Spark infers a filter that finds the words of every row again
        return own.withColumn(f"{p}_key", F.explode_outer(f"{p}_prefix"))

    def dated(df: DataFrame, p: str) -> DataFrame:
        return df.withColumn("date", F.col(f"{p}_date")) if same_day else df

    on = ["date"] * same_day
    met = dated(titles(a, "a"), "a").withColumn("_key", F.col("a_key")).join(dated(titles(b, "b"), "b").withColumn("_key", F.col("b_key")), [*on, "_key"])
    once = met.filter(F.col("a_key") == F.array_min(F.array_intersect("a_prefix", "b_prefix")))
    counted = once.select(*on, "a_w", "b_w", _shared("a_words", "b_words").alias("_n"), F.size("a_words").alias("_x"), F.size("b_words").alias("_y"))
    alike = counted.select(*on, "a_w", "b_w", (F.lit(0.5) * _likeness(F.col("_n"), F.col("_x"), F.col("_y"))).alias("_alike")).filter(F.col("_alike") + (day + 0.2) >= floor - 1e-9)
    places = [dated(df.select(*_keys(p, same_day), f"{p}_place").distinct(), p) for df, p in ((a, "a"), (b, "b"))]
    met = _spread(alike.join(places[0], [*on, "a_w"]), places[1], [*on, "b_w"], ["a_w", "a_v"])
    both = met.select(*_keys("a", same_day), *_keys("b", same_day), "_alike", _shared("a_place", "b_place").alias("_n"), F.size("a_place").alias("_x"), F.size("b_place").alias("_y"))
    score = F.col("_alike") + F.lit(day) + F.lit(0.2) * _likeness(F.col("_n"), F.col("_x"), F.col("_y"))
    return both.select(*_keys("a", same_day), *_keys("b", same_day), score.alias("score")).filter(F.col("score") >= floor)


def _without(sources: DataFrame, banned: DataFrame | None) -> DataFrame:
    return sources if banned is None else sources.join(banned.toDF("_banned"), T.normalize_title(F.col("title")) == F.col("_banned"), "left_anti")


def scored_pairs(sources: DataFrame, happenings: DataFrame, floor: float = 0.6, banned: DataFrame | None = None, any_day: bool = False) -> DataFrame:
    """Scores, from `floor` (over 0.5) on, of sources (id, title, start_date, venue) against happenings of the same columns.

    On the same day the venue gives at most 0.2 and the date 0.3, so titles have a likeness of 2 floor - 1 at least; on
    other days (with `any_day`; these score 0.7 at most) of 2 floor - 0.4. Titles meet by day and by one of their first words, in one order
    of all words, of which such titles share one; each pair is scored once, at the first such word. Rows with equal titles, dates and
    venues are scored as one and each pair of them is a row of the result. Titles of the one-column table `banned` (normalized) are noise and never match.
    """
    if floor <= 0.5:
        raise ValueError("no pair of a day can be left out below a floor of 0.5")
    a, b = _groups(_without(sources, banned), "a"), _groups(happenings, "b")

    def met(same_day: bool) -> DataFrame:
        one_side = _scored(a, b, floor, same_day).join(a.drop("a_words", "a_place"), _keys("a", same_day))
        pairs = _spread(one_side, b.drop("b_words", "b_place"), _keys("b", same_day), ["a_w", "a_v", "a_ids"])
        if not same_day:
            pairs = pairs.filter(~F.coalesce(F.col("a_date") == F.col("b_date"), F.lit(False)))
        one = pairs.select("*", F.explode_outer("a_ids").alias("_a"))
        return one.select("*", F.explode_outer("b_ids").alias("_b")).select(F.col("_a.id").alias("source_happening_id"), F.col("_b.id").alias("happening_id"), "a_title", "a_date", "b_title", "b_date", "score")

    found = met(True)
    return found.unionByName(met(False)) if any_day and floor <= 0.7 else found


def _best(sources: DataFrame, happenings: DataFrame, floor: float) -> DataFrame:
    """source_happening_id, happening_id, score and margin of the best happening of a day for each source that has one from `floor` on.

    Equal rows aren't paired one by one: a group keeps its best score, the least id that has it and the second score.
    """
    a, b = _groups(sources, "a"), _groups(happenings, "b")
    least = b.groupBy(*_keys("b", True)).agg(F.min(F.array_min("b_ids")).alias("least"), F.sum(F.size("b_ids")).alias("n"))
    by_score = _scored(a, b, floor, True).join(least, _keys("b", True)).groupBy(*_keys("a", True), "score").agg(F.min("least").alias("least"), F.sum("n").alias("n"))
    # a group has as many scores as there are likenesses of its few words
    ranked = by_score.groupBy(*_keys("a", True)).agg(F.sort_array(F.collect_list(F.struct("score", "n", "least")), False).alias("_ranked"))
    first, second = F.get("_ranked", F.lit(0)), F.get("_ranked", F.lit(1))
    none = F.lit(None).cast(happenings.schema["id"].dataType)
    entry = lambda score, second, happening: F.struct(score.alias("score"), F.lit(second).alias("_second"), happening.alias("happening_id"))
    both = F.array(entry(first["score"], 0, first["least"]["id"]), entry(F.when(first["n"] > 1, first["score"]).otherwise(second["score"]), 1, none))
    entries = ranked.select(*_keys("a", True), F.filter(both, lambda e: e["score"].isNotNull()).alias("_entries"))
    rows = a.join(entries, _keys("a", True)).select(F.explode_outer("a_ids").alias("_a"), "_entries").select(F.col("_a.id").alias("source_happening_id"), F.inline("_entries"))
    return best_and_margin(rows, ["source_happening_id"], "score", ["_second", "happening_id"]).drop("_second")


def decide(sources: DataFrame, happenings: DataFrame, threshold: float = 0.85, margin: float = 0.05, banned: DataFrame | None = None) -> DataFrame:
    """For each source (id, title, start_date, venue): happening_id, score, margin and decision.

    merge with the best happening from `threshold` on, unless the second is nearer than `margin`: that needs review, as
    does a source without title or date. All others are to be created and have no happening, score or margin. A second further off than `margin` isn't searched; margin is null then.
    """
    floor = threshold - margin - 1e-9
    if floor <= 0.5:
        raise ValueError("no pair of a day can be left out below a floor of 0.5")
    best = _best(_without(sources, banned), happenings, floor).filter(F.col("score") >= threshold)
    near = F.coalesce(F.col("margin") < margin, F.lit(False))
    lacks = (T.normalize_title(F.col("title")) == "") | F.col("start_date").isNull()
    every = sources.select(F.col("id").alias("_id"), lacks.alias("_lacks")).join(best, F.col("_id") == F.col("source_happening_id"), "left")
    decision = F.when(F.col("_lacks") | near, "needs_review").when(F.col("score").isNotNull(), "merge").otherwise("create")
    return every.select(F.col("_id").alias("source_happening_id"), "happening_id", "score", "margin", decision.alias("decision"))


def linked(decisions: DataFrame, priority: Column) -> DataFrame:
    """The only rows that deciding may write: provenance links of merges (source_happening_id, happening_id, source_priority), never a happening's own fields."""
    return decisions.filter("decision = 'merge'").select("source_happening_id", "happening_id", priority.alias("source_priority"), F.lit(False).alias("is_primary"))


def statuses(decisions: DataFrame) -> DataFrame:
    """source_happening_id and the status it flips to: processed when merged or to be created, else needs_review."""
    return decisions.select("source_happening_id", F.when(F.col("decision") == "needs_review", "needs_review").otherwise("processed").alias("status"))


def ambiguous(pairs: DataFrame, threshold: float = 0.85, floor: float = 0.6) -> DataFrame:
    """Rows for the log of ambiguous matches: scores from `floor` to below `threshold`, kept to three digits; pairs of any day, see `scored_pairs`."""
    return pairs.filter((F.col("score") >= floor) & (F.col("score") < threshold)).select(
        "source_happening_id", F.col("happening_id").alias("candidate_happening_id"), F.col("score").cast("decimal(4,3)").alias("confidence_score"),
        F.col("a_title").alias("source_title"), F.col("b_title").alias("candidate_title"), F.lit(None).cast("string").alias("resolution"),
    )
