"""Audits: bags, deltas, votes, ledgers, fingerprints.  Each compares two independent derivations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outer(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join in which null keys are values: the keys, ``a`` and ``b`` (structs of the other columns, null where
    a side has no row) of each pair."""
    left = a.select(*[F.col(k).alias(f"_a{i}") for i, k in enumerate(keys)], F.struct(F.lit(True).alias("_in"), *[c for c in a.columns if c not in keys]).alias("a"))
    right = b.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)], F.struct(F.lit(True).alias("_in"), *[c for c in b.columns if c not in keys]).alias("b"))
    same = reduce(lambda x, y: x & y, [F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}")) for i in range(len(keys))])
    return left.join(right, same, "full_outer").select(*[F.coalesce(f"_a{i}", f"_b{i}").alias(k) for i, k in enumerate(keys)], "a", "b")


def bag_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose multiplicity differs, with both counts; null keys are values.  One shuffle of counts."""
    rows = a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    return rows.groupBy(*keys).agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b")).where("n_a <> n_b")


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, mark: str) -> DataFrame:
    """key, status: missing, unexpected, altered or same; a null key or mark is a value."""
    both = outer(before.select(key, F.col(mark).alias("m")), after.select(key, F.col(mark).alias("m")), [key])
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "unexpected").when(~F.col("a.m").eqNullSafe(F.col("b.m")), "altered").otherwise("same")
    return both.select(key, status.alias("status"))


def transitions(rows: DataFrame, before: Column, after: Column) -> DataFrame:
    """The before/after matrix with its kind of change; nulls are values."""
    kind = F.when(before.eqNullSafe(after), "unchanged").when(before.isNull(), "added").when(after.isNull(), "withdrawn").otherwise("replaced")
    return rows.groupBy(before.alias("before"), after.alias("after"), kind.alias("kind")).agg(F.count("*").alias("n"))


def drift(observed: DataFrame, declared: DataFrame, name: str) -> DataFrame:
    """Names on one side only: undeclared or unobserved; null is a name."""
    both = outer(observed.select(name).distinct(), declared.select(name).distinct(), [name]).where("a IS NULL OR b IS NULL")
    return both.select(name, F.when(F.col("b").isNull(), "undeclared").otherwise("unobserved").alias("status"))


def conserved(counts: dict[str, DataFrame], key: str) -> DataFrame:
    """One count column for each derivation and whether all agree; null is a key, and a key's rows add up."""
    names = list(counts)
    rows = reduce(DataFrame.unionByName, [df.select(key, *[(F.col("n") if n == m else F.lit(0)).cast("long").alias(m) for m in names]) for n, df in counts.items()])
    summed = rows.groupBy(key).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    agree = reduce(lambda x, y: x & y, [F.col(names[0]) == F.col(n) for n in names[1:]])
    return summed.withColumn("balanced", agree)


def row_digest(columns: list[str]) -> Column:
    """A digest that differs for rows that differ: each value goes in with its length, null with none."""
    parts = [F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"))) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def fingerprint(rows: DataFrame, order: str, columns: list[str], by: list[str], span: int = 4096) -> DataFrame:
    """A digest of each group that doesn't depend on how rows are dealt out: rows' digests are digested for each range of
    ``span`` keys, then those.  No task holds a group, only a range and a group's list of ranges."""

    def digest(key, value):
        return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, value.alias("_d")))), lambda x: x["_d"]), ""), 256)

    part = F.floor(F.col(order) / span).alias("_part")
    ranges = rows.groupBy(*by, part).agg(F.count("*").alias("_n"), digest(order, row_digest(columns)).alias("_r"))
    return ranges.groupBy(*by).agg(F.sum("_n").alias("n"), digest("_part", F.col("_r")).alias("digest"))


def vote(ballots: DataFrame, item: str, source: str, choice: str) -> DataFrame:
    """item, support for the modal choice, against, sources, and a verdict; ties go to the smaller choice."""
    counts = ballots.groupBy(item, choice).agg(F.countDistinct(source).alias("n"))
    best = counts.groupBy(item).agg(F.min(F.struct((-F.col("n")).alias("o"), F.col(choice).alias("c"))).alias("b"), F.sum("n").alias("total"))
    return best.select(item, F.col("b.c").alias("winner"), (-F.col("b.o")).alias("support"), (F.col("total") + F.col("b.o")).alias("against"))


def ledger(outcomes: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Outcomes that aren't converted and aren't allowed with the same reason."""
    return outcomes.where("status <> 'converted'").join(allowed.withColumnRenamed(key, "_k").withColumnRenamed("reason", "_r"), (F.col(key) == F.col("_k")) & (F.col("reason") == F.col("_r")), "left_anti")


def agreement(ballots: DataFrame, item: str, lineage: str, choice: str) -> DataFrame:
    """item, lineages, support, against, unknown, consensus: sources of one lineage have one voice, which counts only if
    they agree; a null choice is unknown; the consensus is the choice of all that know one."""
    voice = ballots.groupBy(item, lineage).agg(F.min(choice).alias("lo"), F.max(choice).alias("hi"))
    known = F.when(F.col("lo") == F.col("hi"), F.col("lo"))
    each = voice.select(item, known.alias("c"))
    counts = each.where("c IS NOT NULL").groupBy(item, "c").agg(F.count("*").alias("n"))
    best = counts.groupBy(F.col(item).alias("_i")).agg(F.min(F.struct((-F.col("n")).alias("o"), F.col("c").alias("c"))).alias("b"), F.count("*").alias("kinds"), F.sum("n").alias("told"))
    total = each.groupBy(item).agg(F.count("*").alias("lineages"), F.count_if(F.col("c").isNull()).alias("unknown"))
    both = total.join(best, F.col(item).eqNullSafe(F.col("_i")), "left")
    support = F.coalesce(-F.col("b.o"), F.lit(0))
    return both.select(item, "lineages", support.alias("support"), (F.coalesce("told", F.lit(0)) - support).alias("against"), "unknown", F.when(F.col("kinds") == 1, F.col("b.c")).alias("consensus"))


def delta(before: DataFrame, after: DataFrame, key: str, mark: str) -> DataFrame:
    """key, kind of each key of two tables: added, withdrawn, replaced or unchanged; a null key or mark is a value."""
    both = outer(before.select(key, F.col(mark).alias("m")), after.select(key, F.col(mark).alias("m")), [key])
    kind = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "withdrawn").when(F.col("a.m").eqNullSafe(F.col("b.m")), "unchanged").otherwise("replaced")
    return both.select(key, kind.alias("kind"))


def population(observed: DataFrame, expected: dict[str, int]) -> DataFrame:
    """name, observed, expected, ok: fixed counts against what there is; ``observed`` has name and n."""
    literal = F.explode(F.map_from_arrays(F.array(*map(F.lit, expected)), F.array(*[F.lit(v).cast("long") for v in expected.values()])))
    wanted = observed.sparkSession.range(1).select(literal).select(F.col("key").alias("_k"), F.col("value").alias("expected"))
    both = observed.join(wanted, F.col("name") == F.col("_k"), "full_outer")
    return both.select(F.coalesce("name", "_k").alias("name"), F.coalesce("n", F.lit(0)).alias("observed"), "expected", F.col("n").eqNullSafe(F.col("expected")).alias("ok"))


def ceilings(figures: DataFrame, most: dict[str, float]) -> DataFrame:
    """name, value, most, ok: a gate passes where every figure is at most its ceiling; one without a ceiling fails."""
    limit = F.coalesce(*[F.when(F.col("name") == n, F.lit(float(v))) for n, v in most.items()])
    return figures.select("name", F.col("value").cast("double").alias("value"), limit.alias("most"), F.coalesce(F.col("value") <= limit, F.lit(False)).alias("ok"))


def gates(results: list[tuple[str, DataFrame]], before: DataFrame, after: DataFrame) -> DataFrame:
    """gate, passed, failing of gates, each a table of violations: one plan, which runs when it is asked for.  ``before``
    and ``after`` are one row each that names the state of the inputs; where they differ every gate fails."""
    counts = reduce(DataFrame.unionByName, [v.agg(F.count("*").alias("failing")).select(F.lit(n).alias("gate"), "failing") for n, v in results])
    marks = before.select(F.struct("*").alias("_x")).join(F.broadcast(after.select(F.struct("*").alias("_y"))))  # one row each
    return counts.join(F.broadcast(marks)).select("gate", ((F.col("failing") == 0) & F.col("_x").eqNullSafe(F.col("_y"))).alias("passed"), "failing")
