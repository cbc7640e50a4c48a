"""Discovery of candidate keys."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = 0.02  # relative standard error of the estimates
SURE = 0.8  # a key's estimate is ten standard errors above this share of the rows
SETS_AT_ONCE = 200
SLICES = 64  # sets that are no keys by far show it in one slice of their hashes


def candidate_keys(df: DataFrame, max_width: int = 2) -> DataFrame:
    """Minimal column sets, up to a width, that are never null and never repeat.

    Level by level.  One pass estimates the distinct values of all open sets of
    a width by sketches of fixed size; sets that hold a shorter key are left
    out, and so is a set whose column counts multiply to fewer values than there
    are rows.  Only sets whose estimate comes near the number of rows are
    verified: first a slice of the hashes of their values is counted, then all
    hashes of the sets without a repetition there, by one pass over ``grouping
    sets``.  Where hashes meet, the values themselves are compared.
    """
    columns = df.columns
    stats = df.agg(
        F.count("*").alias("n"),
        *[F.count(F.col(f"`{c}`")).alias(f"full:{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(F.col(f"`{c}`"), ERROR).alias(f"some:{i}") for i, c in enumerate(columns)],
    ).first()
    total = stats["n"]
    some = {c: stats[f"some:{i}"] for i, c in enumerate(columns)}
    usable = [c for i, c in enumerate(columns) if stats[f"full:{i}"] == total]
    found: list[tuple[str, ...]] = []
    for width in range(1, max_width + 1):
        open_ = [s for s in combinations(usable, width) if not any(set(k) <= set(s) for k in found)]
        near = []
        for i in range(0, len(open_) if total else 0, SETS_AT_ONCE):
            sets = [s for s in open_[i : i + SETS_AT_ONCE] if _product(some[c] for c in s) >= SURE * total]
            near += _near(df, sets, total, some) if sets else []
        found += _exact(df, near) if near else []
    rows = [(",".join(s), len(s)) for s in found]
    return df.sparkSession.createDataFrame(rows, "columns string, width int")


def _product(values) -> float:
    out = 1.0
    for v in values:
        out *= v
    return out


def _near(df: DataFrame, sets: list[tuple[str, ...]], total: int, some: dict[str, int]) -> list[tuple[str, ...]]:
    """The sets that may have as many values as there are rows."""
    wide = [s for s in sets if len(s) > 1]
    counts = df.agg(*[F.approx_count_distinct(F.xxhash64(*[F.col(f"`{c}`") for c in s]), ERROR) for s in wide]).first() if wide else []
    estimate = {(c,): n for c, n in some.items()} | dict(zip(wide, counts))
    return [s for s in sets if estimate[s] >= SURE * total]


def _hash(columns: tuple[str, ...]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def _exact(df: DataFrame, sets: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """The sets of which no combination of values occurs twice.

    Sets that repeat within one slice of their hashes are refuted there; only
    the others are grouped whole.
    """
    out = []
    for i in range(0, len(sets), 60):  # a grouping number has 64 bits
        some = sets[i : i + 60]
        refuted = _repeated(df, _met_in_slice(df, some))
        some = [s for s in some if s not in refuted]
        met = _met(df, some) if some else {}
        refuted = _repeated(df, met)
        for s in some:
            if s not in met or (s not in refuted and df.groupBy(*[F.col(f"`{c}`") for c in s]).count().filter("count > 1").isEmpty()):
                out.append(s)
    return out


def _met_in_slice(df: DataFrame, sets: list[tuple[str, ...]]) -> dict[tuple[str, ...], int]:
    """Of each set with a hash that occurs twice in the slice, one such hash."""
    pairs = F.explode(F.array(*[F.struct(F.lit(j).alias("set"), _hash(s).alias("h")) for j, s in enumerate(sets)]))
    sliced = df.select(pairs.alias("p")).select("p.set", "p.h").filter(F.pmod("h", F.lit(SLICES)) == 0)
    twice = sliced.groupBy("set", "h").count().filter("count > 1").groupBy("set").agg(F.min("h").alias("h"))
    return {sets[r["set"]]: r["h"] for r in twice.collect()}


def _met(df: DataFrame, sets: list[tuple[str, ...]]) -> dict[tuple[str, ...], int]:
    """The same over all hashes."""
    names = [f"h{j}" for j in range(len(sets))]
    hashed = df.select(*[_hash(s).alias(n) for n, s in zip(names, sets)])
    grouped = hashed.groupingSets([[F.col(n)] for n in names], *names).agg(F.count("*").alias("n"), F.grouping_id().alias("set"))
    twice = grouped.filter("n > 1").groupBy("set").agg(F.min(F.coalesce(*names)).alias("h")).collect()
    return {s: r["h"] for r in twice for j, s in enumerate(sets) if r["set"] == ((1 << len(sets)) - 1) ^ (1 << (len(sets) - 1 - j))}


def _repeated(df: DataFrame, met: dict[tuple[str, ...], int]) -> set[tuple[str, ...]]:
    """The sets whose rows of that hash are several and all alike, read in one pass."""
    if not met:
        return set()
    proofs = []
    for s, h in met.items():
        values = F.when(_hash(s) == h, F.struct(*[F.col(f"`{c}`") for c in s]))
        proofs.append((F.count(values) > 1) & (F.min(values) == F.max(values)))
    row = df.agg(*[p.alias(f"p{j}") for j, p in enumerate(proofs)]).first()
    return {s for s, same in zip(met, row) if same}
