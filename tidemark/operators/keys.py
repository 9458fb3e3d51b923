"""Minimal keys of a table, found without candidates being named.

Columns are read as numbers.  Sets of columns grow by one column a level on a sample of bounded size, which refutes nearly all
of them however large the table is.  Sets left over are looked at for repeats a column at a time: rows are dealt by that
column's value, so rows equal in any set with the column meet in one task, which settles all these sets at once by sorting
hashes and comparing the rows whose hashes meet.  A share of the values of all such columns goes first, in one task.  Where every column of a set has a value so
frequent that one task would get too many rows, hashes of 128 bits of the whole set are grouped instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from itertools import combinations
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.staging import stage

SKETCH_BITS = 12  # 4,096 registers: a standard error of 1.6 %
PER_SCAN = 128  # sets that share a scan
SAMPLES = (1 << 14, 1 << 18)  # rows, about, that a set is tried on first
TASK_BYTES = 1 << 25  # of codes that one task sorts, about
TASK_ROWS = 1 << 16  # fewer are not worth a task
EVEN = 8  # a column deals rows evenly if its most frequent value fills no more than this part of a task
LOOKS = (64, 8, 1)  # a set is tried on one of so many values, in the end on all

KEY_SCHEMA = T.StructType(
    [
        T.StructField("key_columns", T.StringType(), False),
        T.StructField("width", T.IntegerType(), False),
        T.StructField("row_count", T.LongType(), False),
    ]
)
KEY_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.StringType, T.VarcharType, T.CharType,
    T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType,
)
ONE_NUMBER = (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

Columns = tuple[str, ...]


def minimal_keys(df: DataFrame, max_columns: int = 3, columns: Sequence[str] | None = None) -> DataFrame:
    """``key_columns, width, row_count`` of every minimal key of up to ``max_columns`` columns.

    A key has no NULL and no two rows alike; it is minimal if no part of it is a
    key.  Only ``columns`` take part if given; floating-point and nested columns
    never do.  ``key_columns`` are joined by commas in the table's order.  An empty
    table shows no key, in a table of one row every column without NULL is one.

    ``df`` is read several times and has to give the same rows each time.  A set that
    is no key is never returned; no key is missed unless hashes of 128 bits meet.
    """
    if max_columns < 1:
        raise ValueError("a key has at least one column")
    known = {f.name: f for f in df.schema.fields}
    absent = [c for c in columns or () if c not in known]
    if absent:
        raise ValueError(f"no such columns: {', '.join(absent)}")
    wanted = set(known if columns is None else columns)
    usable = [f.name for f in df.schema.fields if f.name in wanted and isinstance(f.dataType, KEY_TYPES)]
    rows, usable = _without_nulls(df, usable)
    found = _search(_coded(df, usable), usable, rows, max_columns) if rows and usable else []
    return df.sparkSession.createDataFrame([(",".join(k), len(k), rows) for k in found], KEY_SCHEMA)


def _coded(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns as numbers, equal where the values are: one where 64 bits hold the value, else two hashes."""
    out = []
    for f in (df.schema[c] for c in names):
        c = _col(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            code = c.cast("long")
        elif isinstance(f.dataType, ONE_NUMBER) or isinstance(f.dataType, T.DecimalType) and f.dataType.precision <= 18:
            code = F.xxhash64(c)  # of 64 bits at most, each step of it can be undone: no two values meet
        else:
            code = F.struct(F.xxhash64(F.lit(1), c).alias("one"), F.xxhash64(F.lit(2), c).alias("two"))
        out.append(code.alias(f.name))
    return df.select(*out)


def _without_nulls(df: DataFrame, names: list[str]) -> tuple[int, list[str]]:
    filled = [F.count(_col(c)).alias(f"c{i}") for i, c in enumerate(names)]
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *filled).first()
    return counts["rows"], [c for i, c in enumerate(names) if counts[f"c{i}"] == counts["rows"]]


def _search(df: DataFrame, names: list[str], rows: int, max_columns: int) -> list[Columns]:
    place = {c: i for i, c in enumerate(names)}
    row_bytes = 8 * len(_numbers(df, names))
    size = min(SAMPLES[-1], max(SAMPLES[0], 4 * TASK_BYTES // row_bytes))
    drawn = df if rows <= size else df.where(F.rand(size) < size / rows)
    sample = stage(drawn.toDF(*[f"c{i}" for i in range(len(names))]), "sample").toDF(*names)
    refuted: set[Columns] = {()}
    base: list[Columns] = []  # not refuted by the sample, and no part of them either
    for width in range(1, max_columns + 1):
        sets = [
            s + (c,) for s in refuted if len(s) == width - 1 for c in names[place[s[-1]] + 1 if s else 0 :]
            if all(part in refuted for part in combinations(s + (c,), width - 1))
        ]
        unique = _unrepeated(sample, sets)
        refuted |= set(sets) - set(unique)
        base += unique
    if rows <= size:
        clean = set(base)
    else:
        clean = _settled(df, sample, names, rows, size, base, refuted, max_columns)
    keys = [s for s in clean if not any(part in clean for part in _parts(s))]
    return sorted(keys, key=lambda s: (len(s), [place[c] for c in s]))


def _settled(
    df: DataFrame, sample: DataFrame, names: list[str], rows: int, size: int, base: list[Columns], refuted: set[Columns],
    max_columns: int,
) -> set[Columns]:
    """Sets without a repeat: every key that holds a set of ``base``, unless a part of it is among them already."""
    place = {c: i for i, c in enumerate(names)}
    order = lambda s: (len(s), [place[c] for c in s])
    clean: set[Columns] = set()
    variety = {s[0]: n for s, n in _estimates(sample, [(c,) for c in names]).items()}
    most = _even_share(rows, 8 * len(_numbers(df, names)))
    even = [c for c, share in _largest_shares(sample, names).items() if share <= most]
    looked = False
    while True:
        unsettled, level = set(), set(base)
        while level:  # what holds a set of base, a column more at a time
            open_sets = {s for s in level if s not in clean and not any(part in clean for part in _parts(s))}
            unsettled |= open_sets - refuted
            wider = (tuple(sorted({*s, c}, key=place.get)) for s in open_sets if len(s) < max_columns for c in names if c not in s)
            level = set(wider)
        smallest = sorted((s for s in unsettled if not any(part in unsettled for part in _parts(s))), key=order)
        if not smallest:
            return clean
        used = {c: sum(c in s for s in smallest) for c in names}
        chosen = sorted((c for c in even if used[c]), key=lambda c: (used[c], variety[c]), reverse=True)
        one_of = rows * len(chosen) // (2 * size)
        if one_of > 1 and not looked:
            # Rows with one of so many values of any such column: of rows equal in a set with the column all or none.
            looked = True
            sets = sorted((s for s in unsettled if any(c in s for c in chosen)), key=order)
            some = [F.pmod(_hash((c,), 3), F.lit(one_of)) == 0 for c in chosen]
            refuted |= set(sets) - set(_unrepeated(df.where(reduce(or_, some)), sets))
            continue
        pivot = chosen[0] if chosen else None
        if pivot:
            # The smallest sets alone: what travels is their columns, and most of them are keys.
            sets = [s for s in smallest if pivot in s]
            unique = _unrepeated(df, sets, pivot, rows)
        else:
            sets = unique = smallest
            for share in LOOKS:
                unique = _unrepeated_hashes(df, unique, variety, share)
        clean |= set(unique)
        refuted |= set(sets) - set(unique)


def _parts(s: Columns) -> Iterator[Columns]:
    """The sets with fewer columns in ``s``, in its order."""
    for width in range(1, len(s)):
        yield from combinations(s, width)


def _numbers(df: DataFrame, names: Iterable[str]) -> list[Column]:
    """The numbers that the codes of the columns consist of."""
    out = []
    for c in names:
        nested = isinstance(df.schema[c].dataType, T.StructType)
        out += [_col(c)["one"], _col(c)["two"]] if nested else [_col(c)]
    return out


def _tasks(rows: int, row_bytes: int) -> int:
    return max(1, -(-rows * row_bytes // TASK_BYTES))


def _even_share(rows: int, row_bytes: int) -> float:
    """The largest share of the rows that a value may have whose rows meet in one task."""
    return max(1 / (EVEN * _tasks(rows, row_bytes)), 4 / SAMPLES[-1])


def _largest_shares(df: DataFrame, names: list[str]) -> dict[str, float]:
    """The share of the rows that each column's most frequent value has."""
    entries = [F.struct(F.lit(i).alias("which"), _hash((c,), 1).alias("value")) for i, c in enumerate(names)]
    counts = df.select(F.inline(F.array(*entries))).groupBy("which", "value").count()
    found = counts.groupBy("which").agg(F.max("count").alias("most"), F.sum("count").alias("rows")).collect()
    return dict.fromkeys(names, 1.0) | {names[r.which]: r.most / r.rows for r in found}


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _hash(names: Columns, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[_col(c) for c in names])


def _estimates(df: DataFrame, sets: list[Columns]) -> dict[Columns, float]:
    out: dict[Columns, float] = {}
    for start in range(0, len(sets), PER_SCAN):
        part = sets[start : start + PER_SCAN]
        row = df.agg(
            *[
                F.hll_sketch_estimate(F.hll_sketch_agg(_hash(s, 0), F.lit(SKETCH_BITS))).alias(f"s{i}")
                for i, s in enumerate(part)
            ]
        ).first()
        out |= {s: row[f"s{i}"] for i, s in enumerate(part)}
    return out


def _unrepeated(df: DataFrame, sets: list[Columns], pivot: str | None = None, rows: int = 0) -> list[Columns]:
    """The sets in which no two rows agree; ``sets`` hold those of fewer columns first.

    Without ``pivot`` one task gets all rows, which have to be few; with it, a column of all the sets, about ``rows`` are dealt
    by its value.
    """
    if not sets:
        return []
    names = [c for c in df.columns if any(c in s for s in sets)]
    numbers = _numbers(df, names)
    spans = [len(_numbers(df, [c])) for c in names]
    coded = df.select(*[c.alias(f"n{i}") for i, c in enumerate(numbers)])
    if pivot is None:
        dealt = coded.repartition(1)
    else:
        by = sum(spans[: names.index(pivot)])
        cores = df.sparkSession.sparkContext.defaultParallelism
        parts = max(_tasks(rows, 8 * len(numbers)), min(cores, -(-rows // TASK_ROWS)))
        dealt = coded.repartition(parts, f"n{by}")
    found = dealt.mapInArrow(_repeats([[names.index(c) for c in s] for s in sets], spans, SAMPLES[0]), "which int")
    bad = {r.which for r in found.distinct().collect()}
    return [s for i, s in enumerate(sets) if i not in bad]


def _repeats(sets: list[list[int]], spans: list[int], few: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over a task's batches that gives the places of the sets in which two rows agree.

    Column ``i`` of the sets is ``spans[i]`` columns of the batches.  Everything it needs is in it, so workers import no
    module of this package.
    """

    def mix(x):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def run(batches):
        every = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if every is None or every.num_rows < 2:
            return
        numbers = [c.to_numpy() for c in every.columns]
        del every, batches
        starts = np.cumsum([0, *spans]).tolist()
        columns = [numbers[a:b] for a, b in zip(starts, starts[1:])]
        hashes: dict[int, np.ndarray] = {}

        def hashed(i):
            if i not in hashes:
                salt = np.uint64(0x9E3779B97F4A7C15) * np.arange(starts[i] + 1, starts[i + 1] + 1, dtype=np.uint64)
                hashes[i] = sum((mix(c.view(np.uint64) + s) for c, s in zip(columns[i], salt)), np.zeros(1, np.uint64))
            return hashes[i]

        def agreeing(one, other):
            return frozenset(i for i, c in enumerate(columns) if all(v[one] == v[other] for v in c))

        def repeat(s, upto):
            """The columns in which two rows agree that agree in ``s``."""
            marks = sum((hashed(i)[:upto] for i in s), np.zeros(1, np.uint64))
            ordered = np.sort(marks)
            for mark in ordered[1:][ordered[1:] == ordered[:-1]]:
                met: dict[tuple, int] = {}  # hashes of 64 bits may meet by chance
                for row in np.flatnonzero(marks == mark).tolist():
                    first = met.setdefault(tuple(v[row] for i in s for v in columns[i]), row)
                    if first != row:
                        return agreeing(first, row)
            return None

        clean: set[frozenset] = set()
        agreed: set[frozenset] = set()
        for s in sets:
            whole = frozenset(s)
            parts = (frozenset(s[i] for i in range(len(s)) if part >> i & 1) for part in range(1, 1 << len(s)))
            if any(part in clean for part in parts) or any(whole <= a for a in agreed):
                continue
            found = repeat(s, few) if numbers[0].size > 4 * few else None
            found = found or repeat(s, numbers[0].size)
            if found:
                agreed.add(found)
            else:
                clean.add(whole)
        bad = [i for i, s in enumerate(sets) if any(a.issuperset(s) for a in agreed)]
        yield pa.RecordBatch.from_pydict({"which": pa.array(bad, pa.int32())})

    return run


def _unrepeated_hashes(df: DataFrame, sets: list[Columns], variety: dict[str, float], one_of: int) -> list[Columns]:
    """The sets in which no two rows agree, among rows where a column's hash is divisible by ``one_of``.

    What is shuffled is two hashes for each row and set, whatever the columns hold.
    """
    out: list[Columns] = []
    for start in range(0, len(sets), PER_SCAN):
        part = sets[start : start + PER_SCAN]
        entries = []
        for i, s in enumerate(part):
            entry = F.struct(F.lit(i).alias("which"), _hash(s, 1).alias("one"), _hash(s, 2).alias("two"))
            if one_of > 1:
                widest = max(s, key=lambda c: variety[c])
                entry = F.when(F.pmod(_hash((widest,), 3), F.lit(one_of)) == 0, entry)
            entries.append(entry)
        values = df.select(F.inline(F.array_compact(F.array(*entries))))
        repeated = values.groupBy("which", "one", "two").count().where("count > 1").select("which").distinct()
        bad = {r.which for r in repeated.collect()}
        out += [s for i, s in enumerate(part) if i not in bad]
    return out
