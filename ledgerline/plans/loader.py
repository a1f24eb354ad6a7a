"""Feed loads (Bronze -> Silver / Quarantine -> Golden) and the metrics run.

Control reaches the executors at a handful of writes only: Bronze, the zone
write (Silver and Quarantine in one pass, partitioned by zone) and the new
Golden snapshot. Counts come from ``Observation`` on those writes, never from
extra ``count()`` jobs. Each stage reads the previous stage's written output,
so lineage is cut at every stage and a lost executor re-runs only the tasks
of the current stage. Golden changes only after every earlier stage
succeeded; a failure leaves the current snapshot untouched.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.merge import ACTION, INSERT, STALE, UPDATE
from ledgerline.operators.metrics import longest_run, metrics_summary
from ledgerline.operators.report import report_projection, reason_breakdown
from ledgerline.plans import golden as G
from ledgerline.plans.audit import append, audit_row, roll_if_many
from ledgerline.plans.cleanse import missing_columns, value_rules, with_zone
from ledgerline.operators.dedup import mark_superseded
from ledgerline.plans.entities import SPECS, CleansePolicy, EntitySpec
from ledgerline.plans.read import ODD_YEAR, fact_year
from ledgerline.sources import fs
from ledgerline.sources.csv import FeedError, header_columns, read_feed, too_long
from ledgerline.sources.store import BUCKET, StaleBase, Store, bucket_of, buckets_for

GOLDEN_TABLE = {
    "company": "dim_company",
    "revenue": "fact_company_monthly_financials",
    "expense": "fact_company_monthly_financials",
    "fx_rate": "fx_rate",
}
GOLDEN_SCHEMA = {
    "dim_company": S.DIM_COMPANY,
    "fact_company_monthly_financials": S.FACT_FINANCIALS,
    "fx_rate": S.FX_RATE,
}
MERGE = {
    "company": G.merge_company,
    "revenue": G.merge_revenue,
    "expense": G.merge_expense,
    "fx_rate": G.merge_fx,
}
#: The columns whose hash names the bucket of a row.
LEADING_KEY = {
    "dim_company": ["company_id"],
    "fact_company_monthly_financials": ["company_id"],
    "fx_rate": ["local_currency", "base_currency"],
}
#: Tables with a folder per year.
YEARLY = {"fact_company_monthly_financials"}
SORT_WITHIN = {
    "dim_company": ["company_id"],
    "fact_company_monthly_financials": ["company_id", "month"],
    "fx_rate": ["local_currency", "base_currency", "date"],
}


class AlreadyLoaded(RuntimeError):
    """A retried load whose Golden version is already committed."""


@dataclass
class LoadResult:
    entity: str
    load_uuid: str
    raw_rows: int
    clean_rows: int
    quarantined_rows: int
    by_reason: dict[str, int]
    inserted: int
    updated: int
    quarantine: DataFrame | None = field(repr=False, default=None)
    golden: DataFrame | None = field(repr=False, default=None)
    timings: dict[str, float] = field(default_factory=dict)
    stale: int = 0  # updates refused under on_conflict="newest"

    @property
    def message(self) -> str:
        return (f"{self.entity}: {self.raw_rows} rows read, {self.clean_rows} loaded, "
                f"{self.quarantined_rows} quarantined")


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def load_entity(spark: SparkSession, store: Store, entity: str, path: str | list[str],
                policy: CleansePolicy = CleansePolicy(), load_uuid: str | None = None,
                multiline: bool | None = None, persist_ruled: bool = False,
                preprocess: Callable[[DataFrame], DataFrame] | None = None) -> LoadResult:
    """Load one CSV feed (a file, a folder of files or a list of files).

    ``preprocess``: an optional caller-supplied step applied to the Bronze
    rows (as ``DataFrame.transform``) before cleansing; if it fails, at once or
    while it runs, the load stops before any Golden change and a BRONZE
    failure is audited. ``multiline``: see ``read_feed``.
    """
    spec: EntitySpec = SPECS[entity]
    # Source guards and required columns: checked before Bronze, not audited.
    cols = header_columns(spark, path)
    missing = missing_columns(cols, spec)
    if missing:
        raise FeedError(f"{spec.name}: missing required columns {missing}")
    feed = read_feed(spark, path, multiline, columns=cols)
    return load_frame(spark, store, entity, feed, len(cols), path if isinstance(path, str) else path[0], policy, load_uuid,
                      persist_ruled=persist_ruled, preprocess=preprocess)


class NoRows(FeedError):
    """A feed with a header only: refused like an empty file, not audited."""


def load_frame(spark: SparkSession, store: Store, entity: str, feed: DataFrame, n_cols: int,
               source_name: str, policy: CleansePolicy = CleansePolicy(),
               load_uuid: str | None = None, persist_ruled: bool = False,
               stage_mode: str = "errorifexists",
               preprocess: Callable[[DataFrame], DataFrame] | None = None) -> LoadResult:
    """Load a feed already read as text (``read_feed`` columns: the feed's
    columns, ``_corrupt_record``, ``_row_id``, ``row_ord``).

    ``stage_mode="overwrite"`` makes the Bronze and zone folders of a given
    ``load_uuid`` rewritable, so a retried micro-batch can run again.

    Each stage's audit record is written when the stage ends, so a killed
    driver leaves the trace of what was done. Whatever fails, while a plan is
    built or while it runs, is audited as a failure of its stage.
    """
    spec: EntitySpec = SPECS[entity]
    entity = "fx_rate" if spec.name == "fx_rate" else spec.name
    load_uuid = load_uuid or str(uuid.uuid4())
    missing = missing_columns(feed.columns, spec)
    if missing:
        raise FeedError(f"{entity}: missing required columns {missing}")
    if stage_mode == "overwrite" and store.committed(GOLDEN_TABLE[entity], load_uuid):
        raise AlreadyLoaded(f"{entity} load {load_uuid} is already published")

    def note(stages, status, counts, exc=None):
        append(spark, store.audit_path(), [audit_row(entity, source_name, load_uuid, s, status, n, exc) for s, n in zip(stages, counts)])

    roll_if_many(spark, store.audit_path())
    load = _Load(spark, store, spec, entity, policy, load_uuid, stage_mode, _now())
    stages = [S.STAGE_BRONZE]
    t = [time.perf_counter()]
    try:
        bronze, raw_rows = load.bronze(feed, n_cols, preprocess)
        note(stages, S.STATUS_SUCCESS, [raw_rows])
        t.append(time.perf_counter())
        stages = [S.STAGE_SILVER, S.STAGE_QUARANTINE]
        seen = load.zones(bronze, persist_ruled)
        clean_rows, rejected = int(seen["clean"]), int(seen["rejected"])
        by_reason = dict(sorted(((r, int(seen[r])) for r in spec.reasons if int(seen[r])), key=lambda x: -x[1]))
        note(stages, S.STATUS_SUCCESS, [clean_rows, rejected])
        t.append(time.perf_counter())
        stages = [S.STAGE_GOLDEN]
        seen = load.golden()
        merged = int(seen["inserted"]) + int(seen["updated"])
        stale = int(seen["stale"])
        note(stages, S.STATUS_SUCCESS, [merged])
        t.append(time.perf_counter())
        stages = [S.STAGE_QUARANTINE]
        late = load.late_rows() if stale else None
        if late is not None:
            note(stages, S.STATUS_SUCCESS, [rejected + stale])
    except NoRows:
        raise
    except Exception as e:
        note(stages, S.STATUS_FAILURE, [0] * len(stages), e)
        raise
    quarantine = load.zone(S.ZONE_QUARANTINE) if rejected else None
    if late is not None:
        quarantine = late if quarantine is None else quarantine.unionByName(late, allowMissingColumns=True)
        by_reason[S.OLDER_THAN_STORED] = stale
    return LoadResult(entity, load_uuid, raw_rows, clean_rows - stale, rejected + stale, by_reason,
                      int(seen["inserted"]), int(seen["updated"]),
                      quarantine=report_projection(quarantine, spec) if quarantine is not None else None,
                      golden=read_golden(store, GOLDEN_TABLE[entity]),
                      timings={"bronze": t[1] - t[0], "zones": t[2] - t[1], "golden": t[3] - t[2]}, stale=stale)


class _Load:
    """The stages of one load; each reads what the stage before it wrote."""

    def __init__(self, spark, store, spec, entity, policy, load_uuid, mode, run_at):
        self.spark, self.store, self.spec, self.entity, self.policy = spark, store, spec, entity, policy
        self.load_uuid, self.mode, self.run_at = load_uuid, mode, run_at
        self.zones_path = store.zone_path("classified", entity, load_uuid)

    def bronze(self, feed: DataFrame, n_cols: int, preprocess) -> tuple[DataFrame, int]:
        """Text columns + run stamp + file position, written once."""
        raw = G.stamp(feed, self.run_at, self.load_uuid)
        path = self.store.zone_path("bronze", self.entity, self.load_uuid)
        try:
            seen = self.store.write_observed(raw, path, mode=self.mode, metrics={
                "rows": F.count(F.lit(1)),
                "too_long": F.count_if(too_long(F.col("_corrupt_record"), n_cols)),
            })
        except Exception as e:
            if "header does not conform" in str(e):
                raise FeedError(f"{self.entity}: files with differing headers") from e
            raise
        if int(seen["too_long"]):
            raise FeedError(f"{self.entity}: {seen['too_long']} rows with more fields than the header")
        if not int(seen["rows"]):
            raise NoRows(f"{self.entity}: no data rows")
        rows = self.spark.read.schema(raw.schema).parquet(path).drop("_corrupt_record")
        if preprocess is not None:
            done = rows.transform(preprocess)
            missing = missing_columns(done.columns, self.spec) + [c for c in (S.ROW_ID, S.ROW_ORD, S.LOADED_AT, S.LOAD_UUID) if c not in done.columns]
            if missing:
                raise FeedError(f"{self.entity}: preprocess dropped columns {missing}")
            # Written, so that a failure while it runs belongs to this stage.
            prepared = self.store.zone_path("prepared", self.entity, self.load_uuid)
            done.write.mode(self.mode).parquet(prepared)
            rows = self.spark.read.schema(done.schema).parquet(prepared)
        return rows, int(seen["rows"])

    def zones(self, bronze: DataFrame, persist_ruled: bool) -> dict:
        """Silver + Quarantine: one classified frame, one write partitioned by zone.

        The ruled frame feeds the winner aggregate and the final
        classification. By default it is written once beside the zones and
        deleted after the zone write: the text is parsed and joined with the
        dimension once, and the winner side reads only its key, order and reason
        columns. Caching it instead would put the whole feed into executor
        memory and local disks at scale; ``persist_ruled`` does so
        (MEMORY_AND_DISK; lost blocks are recomputed). The file position has
        served by then and is not written again; the row id leads back to it.
        """
        dim = None
        if self.spec.uses_dim:
            dim = self.store.read("dim_company", S.DIM_COMPANY).select("company_id")
        ruled = value_rules(bronze, self.spec, dim, self.policy)
        ruled_path = self.store.zone_path("ruled", self.entity, self.load_uuid)
        if persist_ruled:
            ruled = ruled.persist(StorageLevel.MEMORY_AND_DISK)
        else:
            ruled.write.mode(self.mode).parquet(ruled_path)
            ruled = self.spark.read.schema(ruled.schema).parquet(ruled_path)
        reason = F.col(S.REASON)
        metrics = {"clean": F.count_if(reason.isNull()), "rejected": F.count_if(reason.isNotNull())}
        metrics.update({r: F.count_if(reason == r) for r in self.spec.reasons})
        try:
            classified = mark_superseded(ruled, self.spec.keys, self.spec.order(self.policy), drop=[S.ROW_ORD])
            classified = with_zone(self.spec.finish(classified))
            self.zone_schema = classified.drop(S.ZONE).schema
            seen = self.store.write_observed(classified, self.zones_path, metrics, partition_by=[S.ZONE], mode=self.mode)
        finally:
            if persist_ruled:
                ruled.unpersist()
            else:
                fs.delete(self.spark, ruled_path)
        self.clean_rows = int(seen["clean"])
        self.has_clean = bool(self.clean_rows)
        return seen

    def zone(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.zone_schema).parquet(f"{self.zones_path}/{S.ZONE}={name}")

    def golden(self, attempts: int = 3) -> dict:
        """Merge the Silver rows into the current version, publish a new one.
        Only the parts that the feed touches (years of a fact, buckets of the
        leading key) are read and written, or all of them when the table gets
        more buckets. Whoever loses a race for the next version merges again
        into the new one."""
        silver = self.zone(S.ZONE_SILVER) if self.has_clean else self.spark.createDataFrame([], self.zone_schema)
        silver = silver.drop(S.REASON)
        table = GOLDEN_TABLE[self.entity]
        schema = GOLDEN_SCHEMA[table]
        action = F.col(ACTION)
        counts = {"inserted": F.count_if(action == INSERT), "updated": F.count_if(action == UPDATE), "stale": F.count_if(action == STALE)}
        merge_args = {"scoped": False, "on_conflict": self.policy.on_conflict} if table in YEARLY else {}
        for attempt in range(attempts):
            base = self.store.current(table)
            self.base = base
            years = max(1, len({p.split("/")[0] for p in base.parts})) if base and table in YEARLY else 1
            now = base.buckets if base else self.store.least_buckets
            buckets = buckets_for(((base.total if base else 0) + self.clean_rows) // years, now)
            grown = base is not None and buckets != base.buckets
            by = part_columns(table, buckets)
            parts = parts_in(silver, table, buckets)
            target = self.store.read(table, schema, entry=base, parts=None if grown else parts)
            if grown and by:
                parts = sorted({*parts, *parts_in(target, table, buckets)})
            merged = with_parts(MERGE[self.entity](target, silver, self.run_at, with_action=True, **merge_args), table, buckets)
            try:
                return self.store.publish(table, merged, self.load_uuid, counts, sort_within=SORT_WITHIN[table], drop_after_observe=[ACTION],
                                          mode="overwrite" if attempt else self.mode, base=base, partition_by=by, parts=parts,
                                          buckets=buckets, replace=grown)
            except StaleBase:
                if attempt == attempts - 1:
                    raise

    def late_rows(self) -> DataFrame:
        """Rows that were refused as older than the stored ones, written to
        Quarantine with their reason."""
        table, silver = GOLDEN_TABLE[self.entity], self.zone(S.ZONE_SILVER)
        stored, source = {"revenue": ("revenue_updated_at", G.revenue_source), "expense": ("expenses_updated_at", G.expense_source)}[self.entity]
        before = self.store.read(table, GOLDEN_SCHEMA[table], entry=self.base)
        # Refused keys: those whose stored record is still the one of an earlier load.
        late = (silver.join(before.where(F.col(stored).isNotNull()).select("company_id", "month", F.col(stored).alias("_stored")), ["company_id", "month"])
                .where(F.col("updated_at").isNull() | (G.stored_time(F.col("updated_at")) < F.col("_stored")))
                .drop("_stored").withColumn(S.REASON, F.lit(S.OLDER_THAN_STORED)).select(*self.zone_schema.names))
        path = self.store.zone_path("late", self.entity, self.load_uuid)
        late.write.mode(self.mode).parquet(path)
        return self.spark.read.schema(self.zone_schema).parquet(path)


def quarantine_with_raw(spark: SparkSession, store: Store, entity: str, load_uuid: str) -> DataFrame:
    """Quarantined rows of one load with the text they arrived with.

    Normalisation turns unparsable text into NULL; the received text stays in
    Bronze under the same row id, so it is joined back on demand (the
    quarantine is usually small, so AQE broadcasts it) instead of being
    carried through the load.
    """
    spec = SPECS[entity]
    entity = "fx_rate" if spec.name == "fx_rate" else spec.name
    q = spark.read.parquet(f"{store.zone_path('classified', entity, load_uuid)}/{S.ZONE}={S.ZONE_QUARANTINE}")
    bronze = spark.read.parquet(store.zone_path("bronze", entity, load_uuid))
    raw = bronze.select(S.ROW_ID, *[F.col(c).alias(f"{c}_raw") for c in spec.parsed if c in bronze.columns])
    return q.join(raw, S.ROW_ID, "left")


def part_columns(table: str, buckets: int) -> list[str]:
    """The columns that a table's folders are named by."""
    return [S.YEAR] * (table in YEARLY) + [BUCKET] * (buckets > 1)


def with_parts(df: DataFrame, table: str, buckets: int) -> DataFrame:
    """Rows with the part columns of their table."""
    if table in YEARLY:
        df = df.withColumn(S.YEAR, fact_year(F.col("month")))
    return df.withColumn(BUCKET, bucket_of(LEADING_KEY[table], buckets)) if buckets > 1 else df


def parts_in(rows: DataFrame, table: str, buckets: int) -> list[str] | None:
    """The parts that rows belong to, None for a table of one part. Bounded by
    the calendar times the buckets."""
    by = part_columns(table, buckets)
    if not by:
        return None
    keys = LEADING_KEY[table] + ["month"] * (table in YEARLY)
    found = with_parts(rows.select(*keys), table, buckets).select(*by).distinct().collect()
    return sorted("/".join(f"{c}={r[c]}" for c in by) for r in found)


def parts_of_company(entry, company_id) -> list[str] | None:
    """The parts of a version that may hold a company: one bucket of each year."""
    if entry is None or entry.buckets == 1:
        return None
    one = SparkSession.active().range(1).select(F.lit(str(company_id)).alias("company_id")).select(bucket_of(["company_id"], entry.buckets)).first()[0]
    return [p for p in entry.parts if p.endswith(f"{BUCKET}={one}")]


def read_golden(store: Store, table: str, version: str | None = None, with_year: bool = False, company_id: str | None = None) -> DataFrame:
    """A Golden table. ``with_year`` adds the fact's partition column, by which
    filtered reads skip the folders of other years. With ``company_id`` only
    the folders that may hold that company are opened (filter the result by it:
    a bucket holds other companies as well)."""
    entry, parts = None, None
    if company_id is not None:
        entry = store.entry_of(table, version) if version else store.current(table)
        parts = parts_of_company(entry, company_id)
    return store.read(table, GOLDEN_SCHEMA[table], version, entry=entry, parts=parts, partition_col=S.YEAR if with_year and table in YEARLY else None)


#: Rows of odd months that one company may have before its window is spread over tasks.
WINDOW_ROWS = 1_000_000


def calculate_metrics(spark: SparkSession, store: Store, company_id: str | None = None) -> dict:
    """Recompute the four metric columns (all companies or one) and publish.

    The summary counts the rows of the scope, on the way of the write. For one
    company only the years that hold it are read and written again."""
    table = "fact_company_monthly_financials"
    for attempt in range(3):
        base = store.current(table)
        scope = F.lit(True)
        parts = sorted(base.parts) if base else []
        if company_id is not None:
            scope = F.col("company_id") == str(company_id)
            fact = store.read(table, S.FACT_FINANCIALS, entry=base, parts=parts_of_company(base, company_id))
            parts = parts_in(fact.where(scope), table, base.buckets if base else 1)
        if not parts:
            return {"status": "no_data", "message": f"No rows found in {table} to compute metrics for.", "company_id": company_id,
                    "total_rows": 0, "eligible_rows": 0, "updated_rows": 0}
        part = store.read(table, S.FACT_FINANCIALS, entry=base, parts=parts)
        # Months bound a company's window; only odd month text, in a folder of its own, can go beyond that.
        odd = [p for p in parts if p.startswith(f"{S.YEAR}={ODD_YEAR}")]
        spread = bool(odd) and longest_run(store.read(table, S.FACT_FINANCIALS, entry=base, parts=odd)) > WINDOW_ROWS
        new = with_parts(G.merge_metrics(part, company_id, spread), table, base.buckets)
        eligible = F.col("revenue").isNotNull() & F.col("expenses").isNotNull()
        version = f"metrics-{uuid.uuid4()}"
        try:
            seen = store.publish(table, new, version, {"total": F.count_if(scope), "eligible": F.count_if(scope & eligible)},
                                 sort_within=SORT_WITHIN[table], base=base, partition_by=part_columns(table, base.buckets), parts=parts,
                                 buckets=base.buckets)
        except StaleBase:
            if attempt == 2:
                raise
            continue
        return {"status": "success", "message": f"Metrics computed and saved for {int(seen['eligible'])} eligible rows.",
                "company_id": company_id, "total_rows": int(seen["total"]), "eligible_rows": int(seen["eligible"]),
                "updated_rows": int(seen["total"]), "computed_at": datetime.now(timezone.utc).isoformat(), "version": version}


__all__ = ["load_entity", "calculate_metrics", "read_golden", "LoadResult", "reason_breakdown",
           "metrics_summary"]
