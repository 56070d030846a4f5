"""The full build: raw -> silver (staging, intermediate) -> gold (marts).

``Models`` wires every model lazily over one set of staging frames, so a
caller can pull any single model and Catalyst sees (and prunes) the whole
chain; stored tables take the place of the models of their names.
``materialize`` runs the production build: staging is written once to the silver
layer (cutting lineage, and sharing the typed events), audited, and the
intermediate models and the marts are computed from it; everything is published
as one release, or nothing is.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import DataFrame

from tidemark.operators import extensions as E
from tidemark.operators import intermediate as I
from tidemark.operators import marts as M
from tidemark.operators import quality as Q
from tidemark.operators import reports as R
from tidemark.operators import staging as S
from tidemark.schemas import RAW_SCHEMAS
from tidemark.sources.sinks import Build, Layout, Release

STAGING = ("stg_events", "stg_products", "stg_customers")
INTERMEDIATE = ("int_customer_orders", "int_loyal_customers", "int_product_performance",
                "int_discount_usage")
MARTS = ("mart_sales_by_month", "mart_channel_performance", "mart_loyal_customers",
         "mart_discount_analysis", "mart_asp_by_country", "mart_addon_attach_rate",
         "mart_billing_cycle_revenue")


class Models:
    """Every model of the build over one set of raw tables. ``stored`` names
    tables that are written already and are used in place of their models."""

    def __init__(self, raw: dict[str, DataFrame] | None = None,
                 threshold: int = I.LOYALTY_THRESHOLD,
                 stored: dict[str, DataFrame] | None = None, lenient: bool = False):
        self.raw = raw or {}
        self.threshold = threshold
        self.lenient = lenient
        # a cached property that has its value already is not computed
        self.__dict__.update(stored or {})

    # staging
    @cached_property
    def stg_events(self) -> DataFrame:
        return S.stg_events(self.raw["events"], self.lenient)

    @cached_property
    def stg_products(self) -> DataFrame:
        return S.stg_products(self.raw["products"], self.lenient)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return S.stg_customers(self.raw["customers"], self.lenient)

    # intermediate
    @cached_property
    def int_customer_orders(self) -> DataFrame:
        return I.int_customer_orders(self.stg_events)

    @cached_property
    def int_loyal_customers(self) -> DataFrame:
        return I.int_loyal_customers(self.int_customer_orders, self.stg_customers, self.threshold)

    @cached_property
    def int_product_performance(self) -> DataFrame:
        return I.int_product_performance(self.stg_events, self.stg_products)

    @cached_property
    def int_discount_usage(self) -> DataFrame:
        return I.int_discount_usage(self.stg_events, self.threshold)

    # marts
    @cached_property
    def mart_sales_by_month(self) -> DataFrame:
        return M.mart_sales_by_month(self.stg_events, self.threshold)

    @cached_property
    def mart_channel_performance(self) -> DataFrame:
        return M.mart_channel_performance(self.stg_events, self.threshold)

    @cached_property
    def mart_loyal_customers(self) -> DataFrame:
        return M.mart_loyal_customers(self.int_loyal_customers)

    @cached_property
    def mart_discount_analysis(self) -> DataFrame:
        return M.mart_discount_analysis(self.int_discount_usage)

    @cached_property
    def mart_asp_by_country(self) -> DataFrame:
        return M.mart_asp_by_country(self.stg_events)

    @cached_property
    def mart_addon_attach_rate(self) -> DataFrame:
        return M.mart_addon_attach_rate(self.stg_events, self.stg_products)

    @cached_property
    def mart_billing_cycle_revenue(self) -> DataFrame:
        return M.mart_billing_cycle_revenue(self.stg_events, self.stg_products, self.threshold)

    # reports
    def report(self, name: str) -> DataFrame:
        builders = {
            "rep_loyal_share": lambda: R.rep_loyal_share(self.int_loyal_customers),
            "rep_peak_month": lambda: R.rep_peak_month(self.mart_sales_by_month),
            "rep_channel_rank": lambda: R.rep_channel_rank(self.mart_channel_performance),
            "rep_region_revenue_share": lambda: R.rep_region_revenue_share(self.mart_asp_by_country),
            "rep_country_pricing": lambda: R.rep_country_pricing(self.mart_asp_by_country),
            "rep_loyal_by_segment": lambda: R.rep_loyal_by_segment(self.mart_loyal_customers),
            "rep_loyal_by_age_band": lambda: R.rep_loyal_by_age_band(self.mart_loyal_customers),
            "rep_loyal_by_acquisition": lambda: R.rep_loyal_by_acquisition(self.mart_loyal_customers),
            "rep_discount_rank": lambda: R.rep_discount_rank(self.mart_discount_analysis),
            "rep_attach_range": lambda: R.rep_attach_range(self.mart_addon_attach_rate),
            "rep_billing_cycle": lambda: R.rep_billing_cycle(self.stg_events, self.stg_products),
            "ext_primary_channel_mode": lambda: E.ext_primary_channel_mode(self.stg_events),
            "ext_loyal_revenue_share": lambda: E.ext_loyal_revenue_share(self.stg_events,
                                                                         self.threshold),
        }
        return builders[name]()

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    def staged(self) -> dict[str, DataFrame]:
        return {n: self.model(n) for n in STAGING}

    def checks(self) -> DataFrame:
        return Q.run_checks(self.raw, self.staged())


REPORTS = ("rep_loyal_share", "rep_peak_month", "rep_channel_rank", "rep_region_revenue_share",
           "rep_country_pricing",
           "rep_loyal_by_segment", "rep_loyal_by_age_band", "rep_loyal_by_acquisition",
           "rep_discount_rank", "rep_attach_range", "rep_billing_cycle",
           "ext_primary_channel_mode", "ext_loyal_revenue_share")


def build(raw: dict[str, DataFrame], threshold: int = I.LOYALTY_THRESHOLD,
          with_reports: bool = False) -> dict[str, DataFrame]:
    """All staging, intermediate and mart models (and optionally the reports)
    as lazy DataFrames over one set of staging frames."""
    m = Models(raw, threshold)
    out = {n: m.model(n) for n in STAGING + INTERMEDIATE + MARTS}
    if with_reports:
        # the global ranking checkpoints its small input when built
        out.update({n: m.report(n) for n in REPORTS})
    return out


def write_concurrently(build: Build, frames: dict[str, DataFrame], layer: str,
                       workers: int = 4) -> dict[str, DataFrame]:
    """Write independent tables of a build as concurrent Spark jobs.

    The marts' late stages are small (a few tasks after aggregation), so
    submitting the jobs together keeps the executors busy instead of running
    one nearly idle job after another.
    """
    if workers <= 1 or len(frames) <= 1:
        return {n: build.write(df, layer, n) for n, df in frames.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(frames))) as pool:
        futures = {n: pool.submit(build.write, df, layer, n) for n, df in frames.items()}
        return {n: f.result() for n, f in futures.items()}


AUDIT = ("silver.quarantine", "silver.data_checks", "silver.rejects")


class ChecksFailed(ValueError):
    """Blocking data checks failed: only the audit tables were published."""


def stage(build: Build, m: Models, workers: int = 4) -> tuple[dict[str, DataFrame], dict]:
    """Write the staged tables and return them with what was observed on the way:
    per table its rows and the failing rows of each not-null and accepted-values check."""
    watched = {n: Q.audited(n, df) for n, df in m.staged().items()}
    tables = write_concurrently(build, {n: df for n, (df, _) in watched.items()}, "silver", workers)
    return tables, {n: seen.get for n, (_, seen) in watched.items()}


def staging_views(layout: Layout) -> dict[str, DataFrame]:
    """The staging models as persistent catalog views over the bronze tables
    (registered by name), in place of written tables."""
    db = layout.database("silver")
    for name in RAW_SCHEMAS:
        source = layout.register("bronze", name)
        layout.spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`stg_{name}` AS "
                         f"{S.staging_sql(name, source)}")
    return {n: layout.spark.table(f"`{db}`.`{n}`") for n in STAGING}


def audit(build: Build, raw: dict[str, DataFrame], staged: dict[str, DataFrame],
          seen: dict[str, dict] | None = None) -> DataFrame:
    """Write what violates the checks as ``silver.quarantine`` and the 14 check
    results as ``silver.data_checks``, and return the results.

    Row checks scan only the tables where the observation saw a failing row (all
    where nothing was observed); keys are counted in one grouping per table.
    """
    tables = {m: df for m, df in {**{f"raw.{k}": v for k, v in raw.items()}, **staged}.items()
              if m in Q.ROW_KEYS}
    found = [Q.key_violations(m, df) for m, df in tables.items()]
    for m, df in tables.items():
        counts = (seen or {}).get(m)
        if counts is None or any(n for name, n in counts.items() if name != "rows"):
            found.append(Q.row_violations(m, df))
    quarantine = build.write(reduce(DataFrame.unionByName, found), "silver", "quarantine")
    return build.write(Q.check_results(quarantine, list(tables)), "silver", "data_checks")


def materialize(raw: dict[str, DataFrame], layout: Layout,
                threshold: int = I.LOYALTY_THRESHOLD,
                workers: int = 4, register: bool = False, lenient: bool = False,
                staging: str = "table",
                blocking: tuple[str, ...] = ("unique",)) -> tuple[dict[str, DataFrame], DataFrame]:
    """Production build: write, audit, publish.

    Staging is written to new versions of the silver tables, the data checks run
    over those, and only then the intermediate models and the marts are built
    and all of them published as one release; readers keep the release before
    until then. A failing check of a staged table named in ``blocking`` (by
    default repeated keys: the marts join at customer and product grain, and a
    repeated event_id would count its revenue twice) stops the build with
    ``ChecksFailed``: then only the check results and the violating rows
    (``silver.quarantine``) are published. Other failures are reported.

    With ``lenient`` text that cannot be cast becomes null and is listed in
    ``silver.rejects``; else it fails the build. With ``staging="view"`` the staged
    tables are catalog views over the bronze tables, which must have been
    loaded. With ``register`` all models are also catalog tables, by the
    layers' schema names. The threshold is kept with the release.

    Returns the written marts and the check results.
    """
    build = layout.begin()
    if staging == "view":
        if lenient:
            raise ValueError("views are strict; build tables to be lenient")
        silver, seen = staging_views(layout), None
    else:
        silver, seen = stage(build, Models(raw, threshold, lenient=lenient), workers)
    if lenient:
        build.write(S.rejects(raw), "silver", "rejects")
    checks = audit(build, raw, silver, seen)
    # at most one row per check (14 rows), safe to bring to the driver
    failed = [r.asDict() for r in checks.where("failures > 0").collect()
              if r["check_name"] in blocking and r["model"] in STAGING]
    if failed:
        build.publish(only=AUDIT)
        raise ChecksFailed(f"blocking checks, e.g. duplicate dimension keys or event ids: {failed}")
    # the customer summary first: the loyal customers are made from it
    m = Models(raw, threshold, stored=silver)
    silver = silver | {"int_customer_orders": build.write(m.int_customer_orders, "silver",
                                                          "int_customer_orders")}
    m = Models(raw, threshold, stored=silver)
    rest = {n: m.model(n) for n in INTERMEDIATE if n not in silver}
    silver |= write_concurrently(build, rest, "silver", workers)
    m = Models(raw, threshold, stored=silver)
    gold = write_concurrently(build, {n: m.model(n) for n in MARTS}, "gold", workers)
    release = build.publish(threshold=int(threshold), staging=staging)
    if register:
        written = INTERMEDIATE if staging == "view" else STAGING + INTERMEDIATE
        for layer, names in (("silver", written), ("gold", MARTS)):
            for name in names:
                layout.register(layer, name, release)
    return gold, checks


def stored_models(layout: Layout, release: Release | None = None) -> Models:
    """The models of a finished build, each read from its table in one release
    (the current one by default), with the build's threshold."""
    release = release or layout.release()
    if "threshold" not in release.settings:
        raise LookupError("the lake has no finished build")
    views = release.settings.get("staging") == "view"
    tables = {n: layout.read("silver", n, release)
              for n in (INTERMEDIATE if views else STAGING + INTERMEDIATE)}
    if views:
        tables |= staging_views(layout)
    return Models(threshold=release.settings["threshold"],
                  stored=tables | {n: layout.read("gold", n, release) for n in MARTS})
