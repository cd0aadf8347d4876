"""Joins, lookups, semi- and anti-joins.

No join carries a broadcast hint: sizes are not known here, so Catalyst and
adaptive execution choose, and skewed keys are split at run time.  The right side
of a semi- or anti-join is first reduced to its distinct keys, which collapses a
hot key before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Number of places rows without a lookup key are spread over.
NULL_SPREAD = 4096


def _equal(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> Column:
    return reduce(Column.__and__, [left[mine] == right[theirs] for mine, theirs in on.items()])


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the greatest one, so that reruns agree."""
    rest = [c for c in df.columns if c not in keys]
    if len(rest) == 1:
        return df.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0]))
    greatest = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return greatest.select(*keys, "_row.*")


def join_parent_key(
    child: DataFrame, parent: DataFrame, on: Mapping[str, str], take: Sequence[str]
) -> DataFrame:
    """Child rows that have a parent, with the parent columns in ``take``."""
    keyed = parent.select(*[F.col(p).alias(f"_p_{p}") for p in on.values()], *take)
    condition = _equal(child, keyed, {c: f"_p_{p}" for c, p in on.items()})
    return child.join(keyed, condition, "inner").select(child["*"], *[keyed[c] for c in take])


def join_composite_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "left")


def join_lookup(
    df: DataFrame, lookup: DataFrame, on: Mapping[str, str], take: Mapping[str, str]
) -> DataFrame:
    """Left lookup; ``take`` maps lookup columns to new names, unmatched stays NULL.

    The lookup must be unique on its key (see :func:`unique_rows`).  Rows with a NULL
    key match nothing; they get a spread value beside the key, or a shuffle would
    bring them all to one task.
    """
    side = lookup.select(
        *[F.col(k).alias(f"_k_{k}") for k in on.values()],
        # Always 0, but no literal: the optimizer would take it out of the join key.
        F.pmod(F.xxhash64(*on.values()), F.lit(1)).alias("_k_spread"),
        *[F.col(c).alias(n) for c, n in take.items()],
    )
    no_key = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    spread = F.when(no_key, F.pmod(F.xxhash64(*df.columns), F.lit(NULL_SPREAD)) + 1).otherwise(0)
    rows = df.withColumn("_spread", spread.cast("bigint"))
    pairs = {**{mine: f"_k_{theirs}" for mine, theirs in on.items()}, "_spread": "_k_spread"}
    joined = rows.join(side, _equal(rows, side, pairs), "left")
    return joined.drop("_spread", "_k_spread", *[f"_k_{k}" for k in on.values()])


def join_inner_left_chain(
    first: DataFrame, second: DataFrame, optional: DataFrame, key: str
) -> DataFrame:
    return first.join(second, key, "inner").join(optional, key, "left")


def join_directory_twice(
    df: DataFrame, directory: DataFrame, to_email: str, from_email: str,
    email: str = "email", name: str = "name",
) -> DataFrame:
    """Names for both addresses; rows with an unknown address or any NULL are dropped."""
    for column, alias in ((to_email, "to_username"), (from_email, "from_username")):
        side = directory.select(F.col(email).alias(column), F.col(name).alias(alias))
        df = df.join(side, column, "inner")
    return df.dropna("any")


def semi_join(df: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key occurs on the right."""
    side = keys.select(*[F.col(k).alias(f"_k_{k}") for k in on.values()]).distinct()
    return df.join(side, _equal(df, side, {m: f"_k_{k}" for m, k in on.items()}), "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose key does not occur on the right; NULL keys stay."""
    side = keys.select(*[F.col(k).alias(f"_k_{k}") for k in on.values()]).distinct()
    return df.join(side, _equal(df, side, {m: f"_k_{k}" for m, k in on.items()}), "left_anti")


def semi_two_level(
    leaf: DataFrame, middle: DataFrame, root: DataFrame,
    leaf_key: Mapping[str, str], middle_key: Mapping[str, str],
) -> DataFrame:
    """Leaf rows whose middle row belongs to one of the root rows."""
    return semi_join(leaf, semi_join(middle, root, middle_key), leaf_key)


def semi_latest_version(df: DataFrame, key: str, version: str, window: DataFrame | None = None) -> DataFrame:
    """Rows whose version time is *some* key's latest one (not always their own)."""
    latest = (window if window is not None else df).groupBy(key).agg(F.max(version).alias("_latest"))
    return semi_join(df, latest, {version: "_latest"})


def not_in(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """SQL ``NOT IN (subquery)`` with its NULL rules, as a plain anti-join.

    A NULL on the right lets no row through; a NULL on the left passes only when
    the right side is empty.  Spark's own plan for NOT IN broadcasts the right side
    whole, so the NULL rules are checked by scalar subqueries instead.
    """
    nulls = keys.where(F.col(key).isNull())
    kept = anti_join(df, keys.where(F.col(key).isNotNull()), {column: key})
    return kept.where(~nulls.exists() & (F.col(column).isNotNull() | ~keys.exists()))


def join_newer_than_loaded(
    staged: DataFrame, loaded: DataFrame, key: Mapping[str, str],
    version: tuple[str, str], same: Mapping[str, str], take: Mapping[str, str],
) -> DataFrame:
    """Staged rows newer than their loaded row and by the same author.

    ``loaded`` has one row per key, so the join never multiplies rows.
    """
    mine, theirs = version
    wanted = {*key.values(), *same.values(), theirs}
    side = loaded.select(
        *[F.col(c).alias(f"_l_{c}") for c in sorted(wanted)],
        *[F.col(c).alias(n) for c, n in take.items()],
    )
    condition = _equal(staged, side, {m: f"_l_{t}" for m, t in {**key, **same}.items()})
    condition = condition & (staged[mine] > side[f"_l_{theirs}"])
    return staged.join(side, condition, "inner").drop(*[f"_l_{c}" for c in sorted(wanted)])


def update_from_join(
    child: DataFrame, parent: DataFrame, on: Mapping[str, str], assign: Mapping[str, str]
) -> DataFrame:
    """New state of ``child``: columns in ``assign`` take the parent's value on a match.

    ``parent`` must be unique on the join columns.
    """
    side = parent.select(
        *[F.col(p).alias(f"_k_{p}") for p in on.values()],
        *[F.col(p).alias(f"_v_{c}") for c, p in assign.items()],
        F.lit(True).alias("_matched"),
    )
    joined = child.join(side, _equal(child, side, {c: f"_k_{p}" for c, p in on.items()}), "left")
    return joined.select(*[
        F.when(F.col("_matched"), F.col(f"_v_{c}")).otherwise(child[c]).alias(c)
        if c in assign else child[c]
        for c in child.columns
    ])


def update_three_way(
    target: DataFrame, stage: DataFrame, dictionary: DataFrame,
    key: str, code: str, assign: Mapping[str, str], code_id: str, target_id: str,
) -> DataFrame:
    """New state of ``target`` from stage ⋈ target ⋈ dictionary.

    ``assign`` maps target to stage columns; ``target_id`` takes the dictionary id
    of the stage row's code.  Rows without a staged change stay as they are.
    """
    changes = stage.join(dictionary.select(code, F.col(code_id).alias("_code_id")), code, "inner")
    side = changes.select(F.col(key).alias("_key"), "_code_id",
                          *[F.col(s).alias(f"_s_{t}") for t, s in assign.items()])
    joined = target.join(side, target[key] == side["_key"], "left")
    changed = F.col("_key").isNotNull()
    columns = []
    for c in target.columns:
        if c == target_id:
            columns.append(F.when(changed, F.col("_code_id")).otherwise(target[c]).alias(c))
        elif c in assign:
            columns.append(F.when(changed, F.col(f"_s_{c}")).otherwise(target[c]).alias(c))
        else:
            columns.append(target[c])
    return joined.select(*columns)


def diff_lists(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values on the left that the right does not have."""
    return anti_join(left.select(column).distinct(), right, {column: column})


def coalesce_identity(
    messages: DataFrame, directory: DataFrame, user_id: str = "user", user_name: str = "username"
) -> DataFrame:
    """Sender id, name and address: by name if given, else by id, the rest looked up.

    The directory has ``id``, ``name`` and ``email``.
    """
    by_id = unique_rows(directory.select("id", "name", "email"), ["id"])
    by_name = unique_rows(directory.select("id", "name", "email"), ["name"])
    out = join_lookup(messages, by_name, {user_name: "name"}, {"id": "_n_id", "email": "_n_email"})
    out = join_lookup(out, by_id, {user_id: "id"}, {"name": "_i_name", "email": "_i_email"})
    named = F.col(user_name).isNotNull()
    return out.withColumns({
        "from_id": F.when(named, F.col("_n_id")).otherwise(F.col(user_id)),
        "from_name": F.when(named, F.col(user_name)).otherwise(F.col("_i_name")),
        "from_email": F.when(named, F.col("_n_email")).otherwise(F.col("_i_email")),
    }).drop("_n_id", "_n_email", "_i_name", "_i_email")
