"""R-11 .. R-14: bulk checks over the feedback -> requirement pool ->
release table workflow (field mapping, hand-over audit, release list,
status chain)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schemas
from cohortloom.functions import dims

# fields of the record that execution fills after the hand-over
EXECUTION_FIELDS = ["owner", "dev", "tester", "submit_date", "release_date", "prd_doc", "ui_doc", "tech_doc"]
RELEASE_REQUIRED = ["name", "module", "type", "priority", *EXECUTION_FIELDS, "brief"]


def normalize_version(v: Column) -> Column:
    """``V1.3.0`` -> ``1.3.0``; blank -> null."""
    out = F.regexp_replace(F.trim(v), r"^[Vv]", "")
    return F.when(out == "", F.lit(None)).otherwise(out)


def backend_version_ok(v: Column) -> Column:
    """``system-batch`` with batch ``MMDD`` or ``YYYYWnn``."""
    return F.coalesce(v.rlike(dims.BACKEND_VERSION_PATTERN), F.lit(False))


def version_track_ok(product: Column, app_version: Column, backend_version: Column) -> Column:
    """App rows fill only the app version; other products only the
    backend version, in the ``system-batch`` form."""
    is_app = product == F.lit(dims.APP_PRODUCT)
    return F.coalesce(
        F.when(is_app, app_version.isNotNull() & backend_version.isNull())
         .otherwise(app_version.isNull() & backend_version_ok(backend_version)),
        F.lit(False))


def pool_clean(pool: DataFrame) -> DataFrame:
    """New requirements without a status get the default status."""
    return pool.withColumn("status", F.coalesce(F.col("status"), F.lit(dims.POOL_DEFAULT_STATUS)))


def pool_to_release(pool: DataFrame) -> DataFrame:
    """Field mapping at hand-over: one release row per pool row.

    title -> name and requester unchanged; module as is; priority P0-P3
    -> P0-P2 (P3 becomes P2 and is marked for re-rating); V-prefixed
    release version -> app version; backend version kept; assessment
    note -> brief; type = product requirement; people, dates and documents
    left for execution.
    """
    p = F.col("priority")
    app_version = normalize_version(F.col("release_version"))
    backend = F.when(F.trim(F.col("backend_version")) == "", F.lit(None)).otherwise(F.col("backend_version"))
    return pool.select(
        F.col("id"),
        F.col("title").alias("name"),
        F.col("module"),
        F.lit(dims.PRODUCT_REQUIREMENT).alias("type"),
        F.when(p == "P3", F.lit("P2")).otherwise(p).alias("priority"),
        (p == "P3").alias("needs_rerate"),
        app_version.alias("app_version"),
        backend.alias("backend_version"),
        F.col("requester"),
        F.col("note").alias("brief"),
        F.lit(dims.RELEASE_STATUS_CHAIN[0]).alias("status"),
        F.col("product"),
        *[F.lit(None).cast("date" if c.endswith("_date") else "string").alias(c) for c in EXECUTION_FIELDS],
        version_track_ok(F.col("product"), app_version, backend).alias("valid_version_track"),
    )


def due_for_handoff(pool: DataFrame) -> DataFrame:
    """Pool rows at the hand-over status with a release version set."""
    return (pool_clean(pool)
            .where((F.col("status") == F.lit(dims.POOL_HANDOFF_STATUS))
                   & normalize_version(F.col("release_version")).isNotNull()))


def handoff_missing(pool: DataFrame, release: DataFrame) -> DataFrame:
    """Due pool rows with no release row of the same name (anti-join)."""
    names = release.select(F.col("name").alias("title"))
    return (due_for_handoff(pool).join(names, "title", "left_anti")
            .select("id", "title", "product", "release_version", "status"))


def version_mismatch(pool: DataFrame, release: DataFrame) -> DataFrame:
    """Pool release version and release app version differ after
    normalizing (null-safe).

    The release side is first reduced to its distinct versions per name
    (lowest release id kept, rows counted), so a repeated title pairs each
    pool row with at most its title's versions, never with every copy.
    """
    p = pool.select("id", "title", normalize_version(F.col("release_version")).alias("pool_version"))
    r = (release.select(F.col("name").alias("title"), F.col("id").alias("release_id"),
                        normalize_version(F.col("app_version")).alias("release_version"))
         .groupBy("title", "release_version")
         .agg(F.min("release_id").alias("release_id"), F.count(F.lit(1)).alias("release_rows")))
    return (p.join(r, "title", "inner")
            .where(~F.col("pool_version").eqNullSafe(F.col("release_version")))
            .select("id", "release_id", "title", "pool_version", "release_version", "release_rows"))


def not_closed(pool: DataFrame, release: DataFrame) -> DataFrame:
    """Released items whose pool row is not yet closed as done."""
    live = release.where(F.col("status") == F.lit(dims.RELEASE_LIVE_STATUS)).select(F.col("name").alias("title"))
    return (pool_clean(pool).join(live.dropDuplicates(["title"]), "title", "inner")
            .where(F.col("status") != F.lit(dims.POOL_DONE_STATUS))
            .select("id", "title", "status"))


def dependency_check(pool: DataFrame) -> DataFrame:
    """Rows with a parent record: whether the parent exists and whether
    both are done (linked records ship together)."""
    p = pool_clean(pool)
    child = p.where(F.col("depends_on").isNotNull()).select("id", "depends_on", F.col("status").alias("child_status"))
    parent = p.select(F.col("id").alias("depends_on"), F.col("status").alias("parent_status"))
    done = F.lit(dims.POOL_DONE_STATUS)
    return (child.join(parent, "depends_on", "left")
            .select("id", "depends_on", "child_status", "parent_status",
                    F.col("parent_status").isNotNull().alias("parent_found"),
                    F.coalesce((F.col("child_status") == done) & (F.col("parent_status") == done),
                               F.lit(False)).alias("both_done"),
                    F.coalesce((F.col("child_status") == done) & (F.col("parent_status") != done),
                               F.lit(False)).alias("parent_behind")))


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def release_source(rows: DataFrame, release_type: str, mapping: dict[str, Column | str], schema: T.StructType = schemas.RELEASE) -> DataFrame:
    """One source of the release table in the table's own shape.

    ``mapping`` names for each field of the table a column of the source
    or an expression over it. Fields that it leaves out are empty. The type
    field is the source's; a mapping to a field that the table lacks, a
    column that the source lacks, a required field without a mapping, or a
    value of another kind than the field's raises before any row is read."""
    fields = {f.name: f.dataType for f in schema}
    problems = [f"no field {c}" for c in mapping if c not in fields]
    problems += [f"field {c} is the source's type" for c in mapping if c == "type"]
    problems += [f"no mapping for {c}" for c in ("id", "name", "status") if c not in mapping]
    problems += [f"no column {c} for {f}" for f, c in mapping.items() if isinstance(c, str) and c not in rows.columns]
    if release_type not in dims.RELEASE_TYPES:
        problems.append(f"no type {release_type}")
    if not problems:
        given = rows.select(*[(F.col(c) if isinstance(c, str) else c).alias(f) for f, c in mapping.items()]).schema
        problems = [f"{f.name} is {f.dataType.simpleString()}, not {fields[f.name].simpleString()}" for f in given
                    if f.dataType not in (fields[f.name], T.NullType())]
    if problems:
        raise ValueError(f"source {release_type}: " + "; ".join(problems))
    columns = {**mapping, "type": F.lit(release_type)}
    cast = {f: columns[f] if f in columns else F.lit(None) for f in fields}
    return rows.select(*[(F.col(c) if isinstance(c, str) else c).cast(fields[f]).alias(f) for f, c in cast.items()])


def release_union(sources: dict[str, tuple[DataFrame, dict[str, Column | str]]]) -> DataFrame:
    """The release table from its sources, type -> (rows, mapping): product
    requirements handed over from the pool, urgent bugs, own optimisations
    of the developers, and problems found online, each in its own shape."""
    parts = [release_source(rows, kind, mapping) for kind, (rows, mapping) in sources.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def release_missing_fields(release: DataFrame) -> DataFrame:
    """Release rows lacking a required field (the version field required
    depends on the product's track)."""
    is_app = F.col("product") == F.lit(dims.APP_PRODUCT)
    checks = [F.when(_blank(F.col(c)), F.lit(c)) for c in RELEASE_REQUIRED]
    checks.append(F.when(is_app & _blank(F.col("app_version")), F.lit("app_version")))
    checks.append(F.when(~is_app & _blank(F.col("backend_version")), F.lit("backend_version")))
    missing = F.array_compact(F.array(*checks))
    return (release.select("id", "name", missing.alias("missing"))
            .where(F.size("missing") > 0)
            .select("id", "name", F.array_join("missing", ",").alias("missing")))


def pool_list(pool: DataFrame, product: str) -> DataFrame:
    """The requirement pool of one product; all products share the pool."""
    return pool_clean(pool).where(F.col("product") == F.lit(product)).select(
        "id", "title", "module", "priority", "release_version", "backend_version", "status")


def release_list(release: DataFrame, version: str, product: str | None = None) -> DataFrame:
    """Everything in one app version: product requirements, urgent bugs,
    R&D and experience optimisations."""
    rows = release.where(normalize_version(F.col("app_version")) == normalize_version(F.lit(version)))
    if product is not None:
        rows = rows.where(F.col("product") == F.lit(product))
    return rows.select("id", "name", "type", "priority", "status", "product")


def release_by_type(release: DataFrame, types=None) -> DataFrame:
    """Items per (app version, type) on the dense grid of the four types."""
    ts = list(types or dims.RELEASE_TYPES)
    versions = release.select(normalize_version(F.col("app_version")).alias("app_version")).distinct()
    grid = versions.select("app_version", F.explode(F.array(*[F.lit(t) for t in ts])).alias("type"))
    counts = (release.select(normalize_version(F.col("app_version")).alias("v"), F.col("type").alias("t"))
              .groupBy("v", "t").agg(F.count(F.lit(1)).alias("items")))
    # items without an app version (backend track) form their own null row
    on = F.col("app_version").eqNullSafe(F.col("v")) & (F.col("type") == F.col("t"))
    return (grid.join(counts, on, "left")
            .select("app_version", "type", F.coalesce(F.col("items"), F.lit(0).cast("bigint")).alias("items")))


def allowed_transitions(chain=None, hold: str | None = dims.RELEASE_HOLD_STATUS) -> list[tuple[str, str]]:
    """Each status to the next in the chain; any open status to hold and
    back from hold."""
    ch = list(chain or dims.RELEASE_STATUS_CHAIN)
    pairs = [(a, b) for a, b in zip(ch, ch[1:])]
    if hold:
        pairs += [(s, hold) for s in ch[:-1]] + [(hold, s) for s in ch[:-1]]
    return pairs


STATUS_BUCKET_MICROS = 86_400_000_000   # one day
STATUS_CHUNK = 4096                      # sequence numbers per cell of equal time


def status_changes(log: DataFrame, bucket_micros: int = STATUS_BUCKET_MICROS, chunk: int = STATUS_CHUNK) -> DataFrame:
    """Each log row with the record's previous status in (ts, seq) order.

    The previous status is carried in two fixed levels, so that a record
    with a third of the log is never sorted in one task, whether its rows
    are spread over time or all have one timestamp. Rows lie in cells
    (record, ts, ``floor(seq / chunk)``), in which ``lag`` runs. The first
    row of a cell takes the last status of the cell before it on its day,
    and the first cell of a day that of the record's previous day. Both
    come from one aggregated row per cell and per day, combined map-side.
    """
    record = ["table_name", "id"]
    cell = [*record, "day", "ts", "part"]
    keyed = (log.withColumn("day", F.floor(F.col("ts") / F.lit(bucket_micros)).cast("bigint"))
             .withColumn("part", F.floor(F.col("seq") / F.lit(chunk)).cast("bigint")))
    last = keyed.groupBy(*cell).agg(F.max(F.struct("seq", "status")).alias("last"))
    days = last.groupBy(*record, "day").agg(F.max(F.struct("ts", "part", "last")).alias("end"))
    days = days.select(*record, "day", F.lag("end.last.status").over(Window.partitionBy(*record).orderBy("day")).alias("before"))
    in_day = Window.partitionBy(*record, "day").orderBy("ts", "part")
    carry = (last.withColumn("inside", F.lag("last.status").over(in_day)).withColumn("n", F.row_number().over(in_day))
             .join(days, [*record, "day"])
             .select(*cell, F.when(F.col("n") == 1, F.col("before")).otherwise(F.col("inside")).alias("carry")))
    inner = Window.partitionBy(*cell).orderBy("seq")
    rows = keyed.select("*", F.lag("status").over(inner).alias("prev_in"), F.row_number().over(inner).alias("rn"))
    return (rows.join(carry, cell, "inner")
            .select("table_name", "id", "seq", "ts", "status",
                    F.when(F.col("rn") == 1, F.col("carry")).otherwise(F.col("prev_in")).alias("prev_status")))


def default_chains() -> dict:
    """Status chain (and hold status) per table of the workflow."""
    return {"release": (dims.RELEASE_STATUS_CHAIN, dims.RELEASE_HOLD_STATUS),
            "pool": (dims.POOL_STATUS_CHAIN, None)}


def status_audit(log: DataFrame, chains: dict | None = None,
                 bucket_micros: int = STATUS_BUCKET_MICROS) -> DataFrame:
    """Status changes that do not move to an allowed next status of the
    row's own table (release or pool chain).

    An unchanged status is not a change. Allowed pairs are a literal
    array of ``table:prev>next`` texts, checked with ``array_contains``
    (no join).
    """
    allowed = F.array(*[F.lit(f"{t}:{a}>{b}") for t, (chain, hold) in (chains or default_chains()).items()
                        for a, b in allowed_transitions(chain, hold)])
    changes = (status_changes(log, bucket_micros)
               .where(F.col("prev_status").isNotNull() & (F.col("prev_status") != F.col("status"))))
    pair = F.concat(F.col("table_name"), F.lit(":"), F.col("prev_status"), F.lit(">"), F.col("status"))
    return (changes.where(~F.array_contains(allowed, pair))
            .select("table_name", "id", "seq", "prev_status", "status"))
