"""Exploratory profile of a table."""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.operators.cleaning import numeric_columns, text_columns
from holdfast.operators.percentiles import exact_percentiles


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def _long(row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return row.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def column_types(df: DataFrame) -> DataFrame:
    """(column_no, column_name, column_type, non_null), one pass."""
    row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return _long(row, [
        F.struct(
            F.lit(i).alias("column_no"), F.lit(c).alias("column_name"),
            F.lit(kind).alias("column_type"), F.col(f"n{i}").alias("non_null"),
        )
        for i, (c, kind) in enumerate(df.dtypes)
    ])


def columns_by_kind(df: DataFrame) -> dict[str, list[str]]:
    numeric = numeric_columns(df)
    return {"numeric": numeric, "other": [c for c in df.columns if c not in numeric]}


def duplicate_counts(df: DataFrame, id_column: str) -> DataFrame:
    """One row: repeated rows with the id, and without it.

    The distinct contents without the id come from the distinct rows with it, so the table is
    shuffled once at full width.
    """
    features = [c for c in df.columns if c != id_column]
    with_id = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    without_id = with_id.groupBy(*features).agg(
        F.sum("__n").alias("__n"), F.count(F.lit(1)).alias("__ids")
    )
    return without_id.agg(
        (F.sum("__n") - F.sum("__ids")).alias("duplicates_with_id"),
        (F.sum("__n") - F.count(F.lit(1))).alias("duplicates_without_id"),
    )


def _kinds(df: DataFrame) -> dict[str, list[tuple[int, Column]]]:
    """(column_no, values) by what the values travel as: numbers and times as such, all else as texts."""
    kinds: dict[str, list[tuple[int, Column]]] = {}
    for i, field in enumerate(df.schema.fields):
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
            kinds.setdefault("bigint", []).append((i, c.cast("bigint")))
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            kinds.setdefault("double", []).append((i, c.cast("double")))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            kinds.setdefault(kind.simpleString(), []).append((i, c))
        else:
            kinds.setdefault("string", []).append((i, _identity_text(field)))
    return kinds


def _unique(array: pa.Array, wide: int):
    """The distinct non-null values of each of ``wide`` columns whose rows lie in ``array`` one after the other.

    Texts come as Arrow arrays, all else as sorted signed 64-bit images, one of zero and one of NaN.
    """
    known = array.is_valid().to_numpy(zero_copy_only=False).reshape(-1, wide).T if array.null_count else None
    texts = None
    if pa.types.is_string(array.type) or pa.types.is_large_string(array.type):
        array = array.dictionary_encode()
        array, texts = array.indices.cast(pa.int64()), array.dictionary
    if pa.types.is_floating(array.type):
        values = array.to_numpy(zero_copy_only=False)
        values = (np.where(np.isnan(values), np.nan, values) + 0.0).view(np.int64)
    else:
        array = array.cast(pa.int32()) if pa.types.is_date32(array.type) else array
        values = array.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    columns = np.ascontiguousarray(values.reshape(-1, wide).T)
    for j, column in enumerate(columns):
        found = _once([column if known is None else column[known[j]]])
        yield found if texts is None else texts.take(pa.array(found))


def _once(parts: list):
    """The distinct values of several arrays of one column."""
    if not isinstance(parts[0], np.ndarray):
        return pa.chunked_array(parts).unique()
    values = np.sort(parts[0] if len(parts) == 1 else np.concatenate(parts))
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def _size(part) -> int:
    return len(part) if isinstance(part, np.ndarray) else len(part) + (part.nbytes >> 3)


def _packed_values(kinds: Sequence[Sequence[int]], doubles: set[int], limit: int):
    """A task's distinct values as (column_no, slice, data): the distinct values of its batches are made distinct together
    when they come to 8 * ``limit`` bytes, and written out if that does not halve them."""
    def found(batches):
        kept: dict[int, list] = {}
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            for columns, lists in zip(kinds, batch.columns):
                for i, part in zip(columns, _unique(lists.flatten(), len(columns))):
                    if len(part):
                        kept.setdefault(i, []).append(part)
                        held += _size(part)
            if held >= limit:
                held = 0
                for i, parts in kept.items():
                    parts[:] = [_once(parts)]
                    held += _size(parts[0])
                if 2 * held >= limit:
                    while kept:
                        i, parts = kept.popitem()
                        yield from _slices(i, parts[0], i in doubles)
                    held = 0
        while kept:
            i, parts = kept.popitem()
            yield from _slices(i, _once(parts), i in doubles)

    return found


#: A value's slice is a function of the value, so equal values of all tasks meet. Runs of 2 ** _RUN_BITS codes share one,
#: so that the steps between a slice's codes are short where values lie close; different runs are spread by a hash.
_SLICE_BITS, _RUN_BITS = 6, 20
_SLICES = 1 << _SLICE_BITS
_DECIMAL = 10_000.0
_MIX = np.uint64(0x9E3779B97F4A7C15)
_HEAD = struct.Struct("<qqQB")


def _slices(i: int, values, double: bool):
    """A column's distinct values as (column_no, slice, data), decimals apart from other doubles."""
    if not isinstance(values, np.ndarray):
        slots = pd.util.hash_array(values.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(_SLICES)
        yield from _dealt(i, values, slots.astype(np.uint8), 0)
        return
    others = values
    if double:  # those with up to four digits after the point travel as whole numbers
        x = values.view(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            whole = np.rint(x * _DECIMAL)
            decimal = (whole / _DECIMAL == x) & (np.abs(whole) < 2.0 ** 53)
        others = values[~decimal]
        codes = np.sort(whole[decimal].astype(np.int64))
        yield from _dealt(i, codes, _slots(codes), 0)
    yield from _dealt(i, others, _slots(others), _SLICES)


def _slots(codes: np.ndarray) -> np.ndarray:
    return (((codes >> _RUN_BITS).view(np.uint64) * _MIX) >> np.uint64(64 - _SLICE_BITS)).astype(np.uint8)


def _dealt(i: int, values, slots: np.ndarray, first: int):
    order = np.argsort(slots, kind="stable")
    ends = np.cumsum(np.bincount(slots, minlength=_SLICES))
    values = values[order] if isinstance(values, np.ndarray) else values.take(pa.array(order))
    pack = _pack if isinstance(values, np.ndarray) else _pack_texts
    made = [(first + k, pack(values[start:end])) for k, (start, end) in enumerate(zip(np.r_[0, ends[:-1]], ends)) if end > start]
    if made:
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(made), i, np.int32)), pa.array([k for k, _ in made], pa.int32()),
            pa.array([data for _, data in made], pa.binary())], names=["column_no", "slice", "data"])


def _pack(codes: np.ndarray) -> bytes:
    """Ascending codes as the first one, the common divisor of the steps, and the steps' bytes by place, compressed."""
    steps = np.diff(codes.view(np.uint64))
    divisor = max(int(np.gcd.reduce(steps)), 1) if len(steps) else 1
    if divisor > 1:
        steps //= np.uint64(divisor)
    width = max((int(steps.max()).bit_length() + 7) // 8, 1) if len(steps) else 1
    planes = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return _HEAD.pack(len(steps), int(codes[0]), divisor, width) + pa.compress(pa.py_buffer(planes), "zstd", asbytes=True)


def _unpack(data: memoryview) -> np.ndarray:
    n, first, divisor, width = _HEAD.unpack_from(data)
    planes = np.frombuffer(pa.decompress(data[_HEAD.size:], n * width, "zstd"), np.uint8).reshape(width, n)
    steps = np.zeros((n + 1, 8), np.uint8)
    steps[1:, :width] = planes.T
    codes = steps.view("<u8").ravel() * np.uint64(divisor)
    codes[0] = np.int64(first).view(np.uint64)
    return np.cumsum(codes, dtype=np.uint64).view(np.int64)


def _pack_texts(values: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([values.cast(pa.large_string())], names=["text"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack_texts(data: memoryview) -> pa.Array:
    with pa.ipc.open_stream(pa.py_buffer(data)) as reader:
        return reader.read_next_batch().column(0)


def _counted(texts: set[int], limit: int):
    """(column_no, n) per slice of rows ordered by (column_no, slice); a slice's values are made distinct as they come."""
    def counts(batches):
        key, parts, held = None, [], 0
        for batch in batches:
            columns, slots, data = batch.columns
            for i, k, packed in zip(columns.to_pylist(), slots.to_pylist(), data):
                if (i, k) != key:
                    if parts:
                        yield _count(key[0], parts)
                    key, parts, held = (i, k), [], 0
                part = (_unpack_texts if i in texts else _unpack)(memoryview(packed.as_buffer()))
                parts.append(part)
                held += _size(part)
                if held >= limit:
                    parts = [_once(parts)]
                    held = _size(parts[0]) // 2  # so that all is not sorted again for every few new ones
        if parts:
            yield _count(key[0], parts)

    return counts


def _count(i: int, parts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([len(_once(parts))], pa.int64())], names=["column_no", "n"])


def _identity_text(field: T.StructField) -> Column:
    """A text that is equal exactly where the values are equal."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0).cast(kind)).cast("string")  # one zero
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")  # an hour that the clock repeats is two
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c.alias("v"))))
    return c.cast("string")


def distinct_counts(df: DataFrame, *, approximate: bool = False, held: int = 16_000_000) -> DataFrame:
    """(column_name, n_distinct) of the non-null values, in one scan whatever the number of columns.

    Tasks keep the distinct values of every column, at most about 8 * ``held`` bytes at a time, so that a row is not
    repeated for every column. Columns go to the tasks' arrays by kind, one list a row; numbers and times stay numbers.
    What travels are slices of a column's distinct values, packed: numbers as the compressed steps between them, some
    bits a value where they lie close. ``approximate=True`` takes sketches instead.
    """
    if approximate:
        return sketch_estimates(distinct_sketches(df))
    kinds = _kinds(df)
    lists = df.select(*[F.array(*[c for _, c in columns]).alias(f"k{i}") for i, columns in enumerate(kinds.values())])
    numbers = {kind: [i for i, _ in columns] for kind, columns in kinds.items()}
    packed = lists.mapInArrow(_packed_values(list(numbers.values()), set(numbers.get("double", ())), held),
                              "column_no int, slice int, data binary")
    counts = packed.repartition("column_no", "slice").sortWithinPartitions("column_no", "slice").mapInArrow(
        _counted(set(numbers.get("string", ())), held), "column_no int, n long")
    return _every_column(df, counts.groupBy("column_no").agg(F.sum("n").alias("n_distinct")))


def _every_column(df: DataFrame, counts: DataFrame) -> DataFrame:
    """A row for every column of ``df``, also for those without a value."""
    columns = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "column_no int, column_name string")
    return columns.join(F.broadcast(counts), "column_no", "left").select(  # a row a column
        "column_name", F.coalesce("n_distinct", F.lit(0).cast("long")).alias("n_distinct"))


def distinct_sketches(df: DataFrame, log_buckets: int = 14) -> DataFrame:
    """(column_name, sketch): one pass, some KB a column. Store them, and tables that come later need no
    second look at the earlier ones (``merge_sketches``)."""
    row = df.agg(*[
        F.hll_sketch_agg(_identity_text(f), F.lit(log_buckets)).alias(f"n{i}")
        for i, f in enumerate(df.schema.fields)
    ])
    return _long(row, [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("sketch"))
        for i, c in enumerate(df.columns)
    ])


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """The sketches of all tables together, from the rows of ``distinct_sketches`` of each."""
    return sketches.groupBy("column_name").agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_estimates(sketches: DataFrame) -> DataFrame:
    return sketches.select("column_name", F.hll_sketch_estimate("sketch").alias("n_distinct"))


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, value, n) of every text column in one job; common values are combined on the
    map side."""
    columns = text_columns(df) if columns is None else list(columns)
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]
    return (
        df.select(F.explode(F.array(*pairs)).alias("p"))
        .select("p.*")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, count, n_distinct, top, freq); among equally frequent values the lowest."""
    return value_counts(df, columns).groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def describe_numbers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, count, mean, std, min, p25, p50, p75, max), exact quartiles, sample std."""
    columns = numeric_columns(df) if columns is None else list(columns)
    quartiles = exact_percentiles(df, columns, [0.25, 0.5, 0.75])
    row = df.agg(*[
        F.struct(
            F.count(c).alias("count"), F.avg(c).alias("mean"),
            F.stddev_samp(F.col(c).cast("double")).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        ).alias(f"s{i}")
        for i, c in enumerate(columns)
    ])
    entries = []
    for i, c in enumerate(columns):
        s = f"s{i}"
        low, middle, high = (F.lit(q).cast("double") for q in quartiles[c])
        entries.append(F.struct(
            F.lit(c).alias("column_name"), F.col(f"{s}.count").alias("count"),
            F.col(f"{s}.mean").alias("mean"), F.col(f"{s}.std").alias("std"),
            F.col(f"{s}.min").alias("min"), low.alias("p25"), middle.alias("p50"),
            high.alias("p75"), F.col(f"{s}.max").alias("max"),
        ))
    return _long(row, entries)


def _known(batch, columns: Sequence[str]):
    """The columns of an Arrow batch as a matrix, with a matrix of what is known; NaN counts as missing."""
    x = np.column_stack([
        batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(columns))
    ])
    known = ~np.isnan(x)
    return np.where(known, x, 0.0), known.astype(float)


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])


def _pair_moments(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) of left[i] and right[j] over the rows where both are known.

    One pass: every task adds up masked matrix products, and only columns x columns sums leave it. Values are
    taken from their column's mean, so the sums of squares do not cancel.
    """
    columns = [*left, *right]
    values = _doubles(df, columns)
    row = values.agg(*[F.avg(F.nanvl(c, F.lit(None).cast("double"))).alias(c) for c in values.columns]).first()
    centre = np.array([0.0 if m is None or not np.isfinite(m) else m for m in row])
    a, b = len(left), len(right)

    def added(batches):
        total = np.zeros((6, a, b))
        for batch in batches:
            x, m = _known(batch, columns)
            x = (x - centre) * m
            x, y, mx, my = x[:, :a], x[:, a:], m[:, :a], m[:, a:]
            total += np.stack([mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y])
        i, j = np.indices((a, b))
        names = ("n", "sx", "sy", "sxx", "syy", "sxy")
        yield pa.RecordBatch.from_pydict({
            "i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32),
            **{name: part.ravel() for name, part in zip(names, total)},
        })

    parts = values.mapInArrow(
        added, "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    )
    sums = ("n", "sx", "sy", "sxx", "syy", "sxy")
    none = df.sparkSession.range(a * b).select(
        F.expr(f"CAST(id DIV {b} AS INT)").alias("i"), F.expr(f"CAST(id % {b} AS INT)").alias("j"),
        *[F.lit(0.0).alias(c) for c in sums],
    )  # a table without rows has its pairs too
    return parts.union(none).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])


def _correlations(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """(left, right, correlation), pairwise complete; null where a column does not vary on these rows.

    A variance below 1e-13 of the mean square is taken for the rounding of none.
    """
    def mean(c: str) -> Column:
        return F.try_divide(F.col(c), F.col("n"))

    def variance(c: str) -> Column:
        v = mean(f"s{c}{c}") - mean(f"s{c}") * mean(f"s{c}")
        return F.when(v > F.lit(1e-13) * mean(f"s{c}{c}"), v)

    def name(index: str, names: Sequence[str]) -> Column:
        return F.element_at(F.array(*[F.lit(c) for c in names]), F.col(index) + 1)

    covariance = mean("sxy") - mean("sx") * mean("sy")
    return _pair_moments(df, left, right).orderBy("i", "j").select(
        name("i", left).alias("left"), name("j", right).alias("right"),
        (covariance / (F.sqrt(variance("x")) * F.sqrt(variance("y")))).alias("correlation"),
    )


def target_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None
                        ) -> DataFrame:
    """(column_name, correlation) with the target, pairwise complete; null without variation."""
    columns = numeric_columns(df) if columns is None else list(columns)
    return _correlations(df, columns, [target]).select(F.col("left").alias("column_name"), "correlation")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(row_name, column_name, correlation) for all pairs, in one pass."""
    columns = numeric_columns(df) if columns is None else list(columns)
    return _correlations(df, columns, columns).toDF("row_name", "column_name", "correlation")


def variance_inflation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, vif), without a constant, over rows where every column is finite.

    One pass builds the matrix of products; the driver inverts it, features by features.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    k = len(columns)

    def products(batches):
        total = np.zeros((k, k))
        for batch in batches:
            x, known = _known(batch, columns)
            x = x[(known.all(axis=1)) & np.isfinite(x).all(axis=1)]
            total += x.T @ x
        i, j = np.indices((k, k))
        yield pa.RecordBatch.from_pydict({
            "i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "g": total.ravel()
        })

    gram = np.zeros((k, k))
    parts = _doubles(df, columns).mapInArrow(products, "i int, j int, g double")
    for r in parts.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        gram[r["i"], r["j"]] = r["g"]
    scale = np.sqrt(np.diag(gram))
    scale[scale == 0] = 1.0
    scaled = gram / np.outer(scale, scale)
    try:
        factors = np.diag(np.linalg.inv(scaled)) * np.diag(scaled)
    except np.linalg.LinAlgError:
        factors = np.full(len(columns), np.inf)
    rows = [(c, float(v)) for c, v in zip(columns, factors)]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")
