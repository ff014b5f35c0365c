"""Loads as next-snapshot functions.

Plain Spark tables have no MERGE or DELETE, so every load here is a
function ``(target, incoming) -> next target``; ``dockhand.sinks`` publishes
the result (a new location, or only the touched partitions).  Building a keyed
load runs jobs: the reduced incoming rows are written to the shared folder and
measured before the plan is returned.  ``session.clear_scratch`` drops those copies once published.

Semantics held (row-by-row INSERT ... ON CONFLICT applied in order):

* key equality is ``=``: a NULL key never conflicts, so NULL-key rows on
  either side bypass the join (they also never pile into one join task);
* duplicate incoming keys: a new key takes the *first* row's unlisted columns
  and the *last* row's listed columns; DO NOTHING keeps the first row.  An
  explicit ``order_by`` is needed for that; without it duplicates raise
  (lazily, inside the job: no extra pass over the data);
* matched-with-NULL differs from unmatched: each side carries a marker.

Scale: incoming is reduced per key with partial aggregation (map-side
combine, so a key holding a third of the rows is pre-reduced before the
shuffle).  Then a size check on the reduced side picks the join:

* small (at most ``broadcast_rows`` rows and ``BROADCAST_BYTES`` measured):
  it is broadcast and the target streams through a broadcast hash join, so
  the (huge) target is never shuffled; new keys are found by a second,
  key-columns-only scan of the target;
* otherwise: a full outer sort-merge join on the key (both sides shuffled).

The reduced incoming rows are staged once in the shared folder first, so
the incoming query runs once and every branch reads the same snapshot.

For partitioned targets, ``dockhand.sinks.partitions.merge_partitions``
also confines the read and rewrite to the partitions the incoming rows touch.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.session import cut_lineage

_T, _S, _N = "__in_target", "__in_source", "__n_rows"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _keys_null(keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = _q(k).isNull()
        cond = c if cond is None else (cond | c)
    return cond


def _check_unique(df: DataFrame, what: str) -> DataFrame:
    """Fail the job if a reduced key came from more than one row."""
    msg = F.lit(f"{what}: duplicate keys in incoming rows; pass order_by to resolve them")
    return df.where(F.when(F.col(_N) > 1, F.raise_error(msg)).otherwise(F.lit(True))).drop(_N)


# Default bounds for broadcasting the reduced incoming side.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
BROADCAST_ROWS_CONF = "dockhand.merge.broadcastRows"


def _value_bytes(f: T.StructField) -> Column:
    """Bytes of one value: measured for types of any width."""
    c = _q(f.name)
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        width = F.octet_length(c)
    elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        width = F.octet_length(F.to_json(F.struct(c)))
    else:
        return F.lit(16 if isinstance(f.dataType, T.DecimalType) else 8).cast("long")
    return F.coalesce(width, F.lit(0)).cast("long") + 8


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a (staged) frame, in one job."""
    width = F.lit(16).cast("long")
    for f in df.schema.fields:
        width = width + _value_bytes(f)
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return row["rows"], row["bytes"] or 0


def fits_broadcast(df: DataFrame, broadcast_rows: int | None = None) -> bool:
    """Size check before a broadcast: rows against the setting, measured bytes against the budget."""
    limit = broadcast_rows
    if limit is None:
        limit = int(df.sparkSession.conf.get(BROADCAST_ROWS_CONF, str(BROADCAST_ROWS)))
    if limit <= 0:
        return False
    rows, size = measured_size(df)
    return rows <= limit and size <= BROADCAST_BYTES


def _stage(reduced: DataFrame, broadcast_rows: int | None) -> tuple[DataFrame, bool]:
    """Write the reduced incoming rows once to the shared folder, then size them.

    Every later use reads this one snapshot: the incoming query runs once, and
    a non-repeatable source cannot disagree with itself between the join
    branches.
    """
    staged = cut_lineage(reduced)
    return staged, fits_broadcast(staged, broadcast_rows)


# Plan nodes that read, choose or combine rows without computing across them.
_READS = {"LogicalRelation", "DataSourceV2ScanRelation", "LocalRelation", "Range", "InMemoryRelation", "Project", "Filter", "Union",
          "SubqueryAlias", "View"}


def _is_scan(df: DataFrame) -> bool:
    """True when reading the frame twice costs two (pruned) scans and gives the same rows both
    times.  An allow list: limits, samples, Python functions and all else is staged by the caller."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() not in _READS or not node.deterministic():
            return False
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return True


def _split(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    nulls = _keys_null(keys)
    return df.where(~nulls), df.where(nulls)


def _order_names(order_by: Sequence[str | Column] | None) -> set[str]:
    return {o for o in (order_by or []) if isinstance(o, str)}


def _check_columns(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                   order_by: Sequence[str | Column] | None = None) -> None:
    """Incoming columns must be target columns (order-only columns excepted)."""
    allowed = set(target.columns) | _order_names(order_by)
    extra = [c for c in incoming.columns if c not in allowed]
    if extra:
        raise KeyError(f"incoming columns not in target: {extra}")
    missing = [k for k in keys if k not in incoming.columns or k not in target.columns]
    if missing:
        raise KeyError(f"key columns missing: {missing}")


def _resolved(names: Mapping[str, object] | Sequence[str], target: DataFrame, keys: Sequence[str], what: str) -> dict[str, str]:
    """Given name -> target column, by the session's case rule; unknown names and keys raise."""
    exact = target.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    fold = (lambda n: n) if exact else str.lower
    have = {fold(c): c for c in target.columns}
    out = {n: have.get(fold(n)) for n in names}
    unknown = [n for n, c in out.items() if c is None]
    if unknown:
        raise KeyError(f"{what}: columns not in target: {unknown}")
    held = {fold(k) for k in keys}
    if any(fold(c) in held for c in out.values()):
        raise KeyError(f"{what}: key columns cannot be updated: {[n for n, c in out.items() if fold(c) in held]}")
    return out


_ORD = "__ord"


def _as_target(df: DataFrame, target: DataFrame,
               order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """Incoming rows shaped like the target (absent columns are NULL).

    With ``order_by``, the ordering is evaluated first (it may use incoming
    columns the target lacks) and carried as one struct column.
    """
    from dockhand.operators.conform import conform_value, matches_case
    from dockhand.operators.keyed import _orderable
    exact = matches_case(df.sparkSession)
    cols = []
    for f in target.schema.fields:
        if f.name in df.columns:
            src = df.schema[f.name].dataType
            # a value that does not fit the target type fails the load (as a
            # database insert would), whatever the session's ANSI setting; nested
            # fields go by name, with the same rules as columns
            cols.append(conform_value(_q(f.name), f.name, src, f.dataType, fill_missing=True, refuse_extra=True, exact=exact).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if order_by:
        # the caller's order first, then the shaped columns as tie-breakers: the
        # chosen first/last row is the same on every (re)computation, and the
        # least or greatest order struct holds that row's values (see _pick)
        lead = [(_q(o) if isinstance(o, str) else o).alias(f"__o{i}") for i, o in enumerate(order_by)]
        fill = [c for f, c in zip(target.schema.fields, cols) if _orderable(f.dataType)]
        cols.append(F.struct(*lead, *fill).alias(_ORD))
    return df.select(*cols)


def _pick(df: DataFrame, column: str, last: bool) -> Column:
    """Aggregate: a column's value in the first or last row by ``__ord``.  All such
    columns share one min or max of the order struct; only columns without an
    order of their own (maps, variants) need a ``min_by``/``max_by``."""
    if column in df.schema[_ORD].dataType.names:
        return (F.max if last else F.min)(_ORD).getField(column)
    return (F.max_by if last else F.min_by)(_q(column), F.col(_ORD))


def append_load(target: DataFrame, incoming: DataFrame, by_name: bool = True) -> DataFrame:
    """Plain append, shaped like the target.

    By name (default): columns the target lacks are an error, target columns
    the incoming rows lack are NULL.  By position: the i-th incoming column
    goes to the i-th target column.  Either way values are cast strictly to
    the target's types, as an INSERT into a typed table would.
    """
    if by_name:
        _check_columns(target, incoming, [])
        return target.unionByName(_as_target(incoming, target))
    if len(incoming.columns) != len(target.columns):
        raise ValueError(f"positional append needs {len(target.columns)} columns, got {len(incoming.columns)}")
    renamed = incoming.toDF(*target.columns)
    return target.union(_as_target(renamed, target))


def first_per_key(incoming: DataFrame, keys: Sequence[str], ordered: bool, what: str) -> DataFrame:
    """One row per (non-NULL) key: the first by ``__ord``; unique otherwise."""
    rest = [c for c in incoming.columns if c not in keys and c != _ORD]
    if ordered and rest:
        return incoming.groupBy(*keys).agg(*[_pick(incoming, c, last=False).alias(c) for c in rest])
    if ordered:
        return incoming.select(*keys).distinct()
    row = F.struct(*[_q(c) for c in rest])
    out = _check_unique(incoming.groupBy(*keys).agg(
        F.any_value(row).alias("__r"), F.count(F.lit(1)).alias(_N)), what)
    return out.select(*[_q(k) for k in keys], *[F.col("__r").getField(c).alias(c) for c in rest])


def upsert_ignore(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  order_by: Sequence[str | Column] | None = None,
                  broadcast_rows: int | None = None) -> DataFrame:
    """ON CONFLICT (keys) DO NOTHING; unseen keys are inserted."""
    keys = list(keys)
    _check_columns(target, incoming, keys, order_by)
    inc = _as_target(incoming, target, order_by)
    s_nn, s_null = _split(inc, keys)
    first = first_per_key(s_nn, keys, bool(order_by), "upsert_ignore")
    first, small = _stage(first, broadcast_rows)
    if not _is_scan(target):
        target = cut_lineage(target)  # read twice below
    t_keys = target.where(~_keys_null(keys)).select(*keys)
    if small:
        # only the target keys that the incoming rows hit (broadcast semi join)
        t_keys = t_keys.join(F.broadcast(first.select(*keys)), on=keys, how="left_semi")
    unseen = first.join(t_keys, on=keys, how="left_anti")
    return target.unionByName(unseen.select(*target.columns)).unionByName(s_null.drop(_ORD))


def _reduce(incoming: DataFrame, keys: Sequence[str], specs: Mapping[str, Column],
            check_unique: bool, what: str) -> DataFrame:
    """groupBy(keys) with one partial aggregate per column (+ uniqueness check)."""
    aggs = [a.alias(c) for c, a in specs.items()]
    if check_unique:
        aggs.append(F.count(F.lit(1)).alias(_N))
        return _check_unique(incoming.groupBy(*keys).agg(*aggs), what)
    return incoming.groupBy(*keys).agg(*aggs)


def _choose(target: DataFrame, keys: Sequence[str], matched: Mapping[str, Column],
            inserted: Mapping[str, Column], in_t: Column, in_s: Column) -> list[Column]:
    cols = []
    for f in target.schema.fields:
        n = f.name
        if n in keys:
            cols.append(_q(n))
            continue
        old = F.col(f"t.`{n}`")
        new = inserted.get(n, F.lit(None).cast(f.dataType))
        upd = matched.get(n, old)
        cols.append(F.when(in_t & in_s, upd).when(in_s, new).otherwise(old).cast(f.dataType).alias(n))
    return cols


def _merge(target: DataFrame, reduced: DataFrame, keys: Sequence[str],
           matched: Mapping[str, Column], inserted: Mapping[str, Column],
           broadcast_rows: int | None = None) -> DataFrame:
    """Per-column choice for matched / new / old rows, joined on the keys.

    ``matched`` and ``inserted`` give expressions over ``t.<col>`` and
    ``s.<col>``; columns absent from ``matched`` keep the target's value.
    """
    keys = list(keys)
    in_t, in_s = F.col(_T).isNotNull(), F.col(_S).isNotNull()
    reduced, small = _stage(reduced, broadcast_rows)
    if not _is_scan(target):
        target = cut_lineage(target)  # read twice below: a target that is more than a scan is computed once
    if small:
        # the target streams through a broadcast join: no shuffle, and NULL
        # keys simply find no match (they stay as they are)
        t = target.withColumn(_T, F.lit(True)).alias("t")
        s = F.broadcast(reduced.withColumn(_S, F.lit(True))).alias("s")
        body = t.join(s, on=keys, how="left").select(*_choose(target, keys, matched, inserted, in_t, in_s))
        hit = target.select(*keys).join(F.broadcast(reduced.select(*keys)), on=keys, how="left_semi")
        fresh = reduced.join(hit, on=keys, how="left_anti").alias("s")
        new_rows = fresh.select(*[
            _q(f.name) if f.name in keys else
            inserted.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema.fields])
        return body.unionByName(new_rows)
    # shuffle path: NULL-key target rows bypass the join (they would all hash
    # to one reducer) and are appended unchanged
    t_nn, t_null = _split(target, keys)
    t = t_nn.withColumn(_T, F.lit(True)).alias("t")
    s = reduced.withColumn(_S, F.lit(True)).alias("s")
    j = t.join(s, on=keys, how="full_outer")
    return j.select(*_choose(target, keys, matched, inserted, in_t, in_s)).unionByName(t_null)


def _payload(inc: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in inc.columns if c not in keys and c != _ORD]


def upsert_update(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  update_columns: Sequence[str],
                  order_by: Sequence[str | Column] | None = None,
                  broadcast_rows: int | None = None) -> DataFrame:
    """ON CONFLICT (keys) DO UPDATE SET c = EXCLUDED.c for listed columns.

    Unlisted columns keep the target's value; new keys are inserted whole.
    """
    keys = list(keys)
    if not update_columns:
        return upsert_ignore(target, incoming, keys, order_by, broadcast_rows)
    _check_columns(target, incoming, keys, order_by)
    listed = list(_resolved(list(update_columns), target, keys, "update_columns").values())
    inc = _as_target(incoming, target, order_by)
    s_nn, s_null = _split(inc, keys)
    rest = _payload(inc, keys)
    if order_by:
        specs = {c: _pick(inc, c, last=c in listed) for c in rest}
    else:
        specs = {c: F.any_value(_q(c), ignoreNulls=False) for c in rest}
    red = _reduce(s_nn, keys, specs, check_unique=not order_by, what="upsert_update")
    matched = {c: F.col(f"s.`{c}`") for c in listed}
    inserted = {c: F.col(f"s.`{c}`") for c in rest}
    return _merge(target, red, keys, matched, inserted, broadcast_rows).unionByName(s_null.drop(_ORD))


def upsert_expr(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                rules: Mapping[str, str | Column], broadcast_rows: int | None = None) -> DataFrame:
    """Custom ON CONFLICT rule: ``{column: expression over t.* and s.*}``.

    Arbitrary rules are order-dependent under duplicates, so incoming keys
    must be unique (checked inside the job).
    """
    keys = list(keys)
    if not rules:
        raise ValueError("upsert_expr needs a conflict rule (the ON CONFLICT text)")
    _check_columns(target, incoming, keys)
    names = _resolved(rules, target, keys, "rules")
    inc = _as_target(incoming, target)
    s_nn, s_null = _split(inc, keys)
    rest = _payload(inc, keys)
    red = _reduce(s_nn, keys, {c: F.any_value(_q(c), ignoreNulls=False) for c in rest},
                  check_unique=True, what="upsert_expr")
    matched = {names[c]: (F.expr(r) if isinstance(r, str) else r) for c, r in rules.items()}
    inserted = {c: F.col(f"s.`{c}`") for c in rest}
    return _merge(target, red, keys, matched, inserted, broadcast_rows).unionByName(s_null)


FOLD_ROWS = 10_000  # rows of one key that a task may fold at once


def _fold(rows: Column, init: Column, names: Sequence[str], rules: Mapping[str, str], types: Mapping[str, T.DataType]) -> Column:
    """Apply the rules to an ordered array of rows, one after another, from ``init``.

    The rule texts name the row so far ``t`` and the incoming row ``s``, which are the
    variables of the lambda: the SQL that a match would run, unchanged.
    """
    made = ", ".join(f"'{c}', CAST({rules.get(c, f't.`{c}`')} AS {types[c].simpleString()})" for c in names)
    return F.call_function("aggregate", rows, init, F.expr(f"(t, s) -> named_struct({made})"))


def upsert_expr_ordered(target: DataFrame, incoming: DataFrame, keys: Sequence[str], rules: Mapping[str, str],
                        order_by: Sequence[str | Column], associative: bool = False, fold_rows: int = FOLD_ROWS,
                        broadcast_rows: int | None = None) -> DataFrame:
    """W4 with repeated keys: rows are applied in order, each rule sees the result of the row before.

    As a database applies single-row INSERT ... ON CONFLICT statements: the
    first row of a new key is inserted whole, every other row runs the rules
    (SQL texts over ``t.*``, the row so far, and ``s.*``) on what is there.  Columns
    without a rule keep what is there.

    One pass groups a key's rows; a key with more than ``fold_rows`` rows fails
    the job with a clear error, since an arbitrary rule cannot be split.
    ``associative=True`` says that folding a run of rows first and applying
    its result gives the same as applying the rows (sums, maxima, first or last values): rows
    are then ranged over tasks by key and order, each task folds its own runs of at most
    ``fold_rows``, and only those results are gathered per key, so a
    key that holds a third of all rows is spread over many tasks.
    """
    from dockhand.operators.keyed import _orderable
    keys = list(keys)
    if not rules:
        raise ValueError("upsert_expr_ordered needs a conflict rule (the ON CONFLICT text)")
    if any(not isinstance(r, str) for r in rules.values()):
        raise TypeError("ordered rules are SQL texts over t.* and s.*")
    if not order_by:
        raise ValueError("upsert_expr_ordered needs order_by")
    _check_columns(target, incoming, keys, order_by)
    names = _resolved(rules, target, keys, "rules")
    texts = {names[c]: r for c, r in rules.items()}
    inc = _as_target(incoming, target, order_by)
    s_nn, s_null = _split(inc, keys)
    rest = [f.name for f in target.schema.fields if f.name not in keys]
    types = {c: target.schema[c].dataType for c in rest}
    unordered = [c for c in rest if not _orderable(types[c])]
    if unordered:
        raise TypeError(f"upsert_expr_ordered: columns without an order of their own: {unordered}")
    payload = F.struct(*[_q(c) for c in rest])
    listed = s_nn.select(*[_q(k) for k in keys], F.struct(_q(_ORD).alias("o"), payload.alias("r")).alias("__x"))
    if associative:
        listed = _folded_runs(listed, keys, rest, texts, types, fold_rows)
    groups = listed.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N), F.sort_array(F.collect_list("__x")).alias("__x"))
    limit = F.lit(f"upsert_expr_ordered: a key has more than {fold_rows} {'folded runs' if associative else 'rows'}; "
                  + ("raise fold_rows" if associative else "use associative=True if the rules allow it, or raise fold_rows"))
    groups = groups.where(F.when(F.col(_N) > fold_rows, F.raise_error(limit)).otherwise(F.lit(True)))
    rows = F.transform("__x", lambda x: x.getField("r"))
    groups, small = _stage(groups.select(*keys, rows.alias("__rows")), broadcast_rows)
    if not _is_scan(target):
        target = cut_lineage(target)
    if small:
        # the target streams past the broadcast groups; new keys are found by a key-only scan
        seen = target.select(*keys).join(F.broadcast(groups.select(*keys)), keys, "left_semi")
        body = target.alias("t").join(F.broadcast(groups), keys, "left")
        fresh = groups.join(seen, keys, "left_anti")
    else:
        t_nn, t_null = _split(target, keys)
        body = t_nn.withColumn(_T, F.lit(True)).alias("t").join(groups, keys, "full_outer")
    old = F.struct(*[F.col(f"t.`{c}`") for c in rest])
    given, later = F.element_at("__rows", 1), F.slice("__rows", 2, F.size("__rows"))

    def shaped(frame: DataFrame, row: Column) -> DataFrame:
        return frame.select(*[_q(k) for k in keys], row.alias("__r")).select(
            *[_q(c) if c in keys else F.col("__r").getField(c).alias(c) for c in target.columns])

    applied = F.when(F.col("__rows").isNull(), old).otherwise(_fold(F.col("__rows"), old, rest, texts, types))
    inserted = _fold(later, given, rest, texts, types)
    if small:
        out = shaped(body, applied).unionByName(shaped(fresh, inserted))
    else:
        out = shaped(body, F.when(F.col(_T).isNull(), inserted).otherwise(applied)).unionByName(t_null)
    return out.unionByName(s_null.drop(_ORD))


def _folded_runs(listed: DataFrame, keys: Sequence[str], rest: Sequence[str], texts: Mapping[str, str],
                 types: Mapping[str, T.DataType], fold_rows: int) -> DataFrame:
    """One row per run of a key's rows: the run's rows folded, at the place of its first row.

    Ranging by key and order gives every task a stretch of the order; a run is
    ``fold_rows`` rows of a key in it, so no row gathers more than that.
    """
    ranged = listed.repartitionByRange(*[_q(k) for k in keys], "__x").sortWithinPartitions(*[_q(k) for k in keys], "__x")
    ranged = ranged.withColumn("__at", F.monotonically_increasing_id())
    ranged = cut_lineage(ranged.withColumn("__run", F.floor(F.col("__at") / F.lit(fold_rows))))  # runs do not cross a task: ids jump
    runs = ranged.groupBy(*keys, "__run", F.shiftright("__at", 33).alias("__part")).agg(F.sort_array(F.collect_list("__x")).alias("__x"))
    first = F.element_at("__x", 1)
    others = F.transform(F.slice("__x", 2, F.size("__x")), lambda x: x.getField("r"))
    return runs.select(*[_q(k) for k in keys], F.struct(first.getField("o").alias("o"),
                                                        _fold(others, first.getField("r"), rest, texts, types).alias("r")).alias("__x"))


# The ready-made accumulate policies.
POLICIES = ("replace", "sum", "coalesce")


def upsert_accumulate(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                      policies: Mapping[str, str],
                      order_by: Sequence[str | Column] | None = None,
                      broadcast_rows: int | None = None) -> DataFrame:
    """Per-column replace / sum / coalesce on conflict.

    Incoming rows are first reduced per key: ``sum`` adds them, ``replace``
    takes the last row's value, ``coalesce`` the last non-NULL value, other
    columns the first row's value.  Then, on a match: ``sum`` adds to the
    target (NULL counts as 0), ``replace`` overwrites, ``coalesce`` keeps the
    target's value where the incoming one is NULL; unlisted keep the target.
    Only ``sum`` is order-free; the others need ``order_by`` under duplicates.
    """
    from dockhand.operators.keyed import _orderable
    keys = list(keys)
    bad = {c: p for c, p in policies.items() if p not in POLICIES}
    if bad:
        raise ValueError(f"unknown policies {bad}; use one of {POLICIES}")
    _check_columns(target, incoming, keys, order_by)
    names = _resolved(policies, target, keys, "policies")
    policies = {names[c]: p for c, p in policies.items()}
    inc = _as_target(incoming, target, order_by)
    s_nn, s_null = _split(inc, keys)
    rest = _payload(inc, keys)
    o = F.col(_ORD) if order_by else None
    present = set(incoming.columns)
    # columns the incoming rows lack are NULL in every row: order plays no part
    order_free = all(policies.get(c) == "sum" for c in rest if c in present)
    specs = {}
    for c in rest:
        p = policies.get(c)
        if c not in present:
            specs[c] = F.any_value(_q(c), ignoreNulls=False)
        elif p == "sum":
            specs[c] = F.sum(_q(c))
        elif o is None:
            specs[c] = F.any_value(_q(c), ignoreNulls=False)
        elif p == "coalesce":
            # the order alone, not the whole row, decides among the rows that have a value
            lead = F.struct(*[o.getField(f"__o{i}") for i in range(len(order_by))], _q(c).alias("v"))
            specs[c] = (F.max(F.when(_q(c).isNotNull(), lead)).getField("v") if _orderable(inc.schema[c].dataType)
                        else F.max_by(_q(c), F.when(_q(c).isNotNull(), o)))
        else:
            specs[c] = _pick(inc, c, last=p == "replace")
    red = _reduce(s_nn, keys, specs, check_unique=(o is None and not order_free), what="upsert_accumulate")
    matched = {}
    for c, p in policies.items():
        tc, sc = F.col(f"t.`{c}`"), F.col(f"s.`{c}`")
        if p == "sum":
            matched[c] = F.coalesce(tc, F.lit(0)) + F.coalesce(sc, F.lit(0))
        elif p == "replace":
            matched[c] = sc
        else:
            matched[c] = F.coalesce(sc, tc)
    inserted = {c: F.col(f"s.`{c}`") for c in rest}
    return _merge(target, red, keys, matched, inserted, broadcast_rows).unionByName(s_null.drop(_ORD))


def delete_then_insert(target: DataFrame, incoming: DataFrame, delete_predicate: str | Column,
                       by_name: bool = True) -> DataFrame:
    """Drop the rows the predicate deletes (NULL outcome keeps), then append.

    Published once, so readers never see the window with the rows deleted.
    """
    from dockhand.operators.conform import keep_where_not
    kept = keep_where_not(target, delete_predicate)
    return append_load(kept, incoming, by_name)
