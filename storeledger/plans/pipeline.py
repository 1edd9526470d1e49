"""The whole run: landed pages, raw tables, rollups, marts, published marts, report."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from storeledger import schemas
from storeledger.operators import flatten, marts, quality, report, rollups, staging
from storeledger.plans.contract import CONTRACT
from storeledger.plans.graph import Model, build
from storeledger.sources import pages as page_sources
from storeledger.sources import tables
from storeledger.sources.versions import Load

# The monthly marts are built but not published.
PUBLISHED = ("money_summary", "product_leaks", "product_margin", "stock_capital")


def flatten_pages(pages: page_sources.Pages) -> dict[str, DataFrame]:
    return {
        "orders": flatten.flatten_orders(pages),
        "order_items": flatten.flatten_items(pages),
        "variants": flatten.flatten_variants(pages),
    }


STAGING = {
    "stg_orders": (staging.stg_orders, "orders"),
    "stg_order_items": (staging.stg_order_items, "order_items"),
    "stg_variants": (staging.stg_variants, "variants"),
}

ROLLUPS = {
    "order_months": (rollups.order_months, "stg_orders"),
    "product_sums": (rollups.product_sums, "stg_order_items"),
    "product_orders": (rollups.product_orders, "stg_order_items"),
    "product_costs": (rollups.product_costs, "stg_variants"),
}

# Each mart with the rollups or staged tables it is computed from, in argument order.
MARTS = {
    "cost_discounts": (marts.cost_discounts, ["order_months"]),
    "cost_refunds": (marts.cost_refunds, ["order_months"]),
    "money_summary": (marts.money_summary, ["order_months", "product_costs"]),
    "product_leaks": (marts.product_leaks, ["product_sums", "product_orders"]),
    "product_margin": (marts.product_margin, ["product_sums", "product_costs"]),
    "stock_capital": (marts.stock_capital, ["stg_variants"]),
}


def _apply(steps: dict, inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: operator(inputs[source]) for name, (operator, source) in steps.items()}


def stage(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return _apply(STAGING, raw)


def roll_up(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return _apply(ROLLUPS, staged)


def build_marts(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All marts from staged tables, unwritten."""
    inputs = {**staged, **roll_up(staged)}
    return {
        name: operator(*[inputs[source] for source in sources])
        for name, (operator, sources) in MARTS.items()
    }


MODELS = (
    {name: Model(operator, (source,)) for name, (operator, source) in STAGING.items()}
    | {name: Model(operator, (source,), stored=True) for name, (operator, source) in ROLLUPS.items()}
    | {name: Model(operator, tuple(sources), stored=True) for name, (operator, sources) in MARTS.items()}
)


def create_views(staged: dict[str, DataFrame]) -> None:
    """Session views of the staged tables, which replace views of these names."""
    for name, rows in staged.items():
        rows.createOrReplaceTempView(name)


def set_bad_pages_aside(spark: SparkSession, pages: DataFrame, root: str) -> page_sources.Archive:
    """Parse every page once, keep them all with their problem, return the good ones."""
    return page_sources.archive_pages(pages, f"{root}/pages").good()


def load(pages: page_sources.Pages, root: str) -> dict[str, int]:
    """Replace the three raw tables from pages, in one commit; returns their row counts."""
    step = Load(_session(pages), root)
    counts = _load(pages, step)
    step.commit()
    return counts


def _session(pages: page_sources.Pages) -> SparkSession:
    return pages.spark if isinstance(pages, page_sources.Archive) else pages.sparkSession


def _load(pages: page_sources.Pages, step: Load) -> dict[str, int]:
    return {name: step.write(name, rows)["rows"] for name, rows in flatten_pages(pages).items()}


class FailedChecks(ValueError):
    """A check of severity error fails; what was built is not made current."""


def model(
    spark: SparkSession,
    root: str,
    views: bool = False,
    targets: Iterable[str] = tuple(MARTS),
    contract: Mapping = CONTRACT,
) -> dict[str, DataFrame]:
    """Build the marts asked for from the current raw tables, in one commit; returns them as written.

    Session views of the staged tables are made on request.
    """
    step = Load(spark, root)
    built = _model(step, targets, contract)
    step.commit()
    if views:
        create_views(stage(_raw(step)))
    return built


def _raw(step: Load) -> dict[str, DataFrame]:
    return {name: step.read(name) for name in schemas.RAW}


def _model(step: Load, targets: Iterable[str], contract: Mapping) -> dict[str, DataFrame]:
    """Write the marts and the rollups they take, each once, with the contract's checks.

    The rollups are shared, so no mart but stock capital reads a large table again. The
    checks are sums over the rows being written, so no mart is read for them; they are kept as the
    table ``checks``, and a failing one of severity error raises.
    """
    found: dict[str, dict] = {}

    def store(name: str, rows: DataFrame) -> DataFrame:
        found[name] = step.write(name, rows, quality.check_sums(contract, name))
        return step.read(name)

    targets = list(targets)
    built = build(MODELS, _raw(step), targets, store)
    checks = quality.checks_frame(step.spark, contract, found)
    step.write("checks", checks)
    failed = checks.filter("severity = 'error' AND NOT passed").collect()
    if failed:
        named = ", ".join(f"{row['check']} of {row['entity']}: {row['failing_rows']} rows" for row in failed)
        raise FailedChecks(f"checks fail, nothing is made current: {named}; see {step.path('checks')}")
    return {name: built[name] for name in targets}


def publish(built: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Copy the published marts to their own root, as one version; returns their row counts."""
    return tables.publish_tables({name: built[name] for name in PUBLISHED}, root)


def reports(built: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "money_tree": report.money_tree(built["money_summary"]),
        "top_capital": report.top_capital(built["stock_capital"]),
        "top_discounted": report.top_discounted(built["product_leaks"]),
    }


class IncompleteLoad(ValueError):
    """Pages, or parts of orders' lines, are missing, repeated or not announced."""


def check_complete(pages: page_sources.Pages, step: Load, allow_gaps: bool = False) -> None:
    """Write the gaps as the table ``gaps``; any raises unless gaps are allowed."""
    found = step.write("gaps", page_sources.load_gaps(pages, step.path("chains")))["rows"]
    if found and not allow_gaps:
        raise IncompleteLoad(f"{found} gaps in the landed pages, listed in {step.path('gaps')}")


def run(
    spark: SparkSession,
    pages: page_sources.Pages,
    root: str,
    allow_gaps: bool = False,
    contract: Mapping = CONTRACT,
) -> dict[str, DataFrame]:
    """Load, model and publish; returns the reports.

    Landed pages are archived first, parsed once; all that follows reads the archive. Raw
    tables, rollups and marts become current in one commit, after which the marts are published:
    an incomplete landing, a bad page, a failing check or a lost job changes nothing.
    """
    step = Load(spark, root)
    if not isinstance(pages, page_sources.Archive):
        pages = page_sources.archive_pages(pages, step.path("pages"))
    check_complete(pages, step, allow_gaps)
    _load(pages, step)
    built = _model(step, MARTS, contract)
    step.commit()
    publish(built, f"{root}/published")
    return reports(built)
