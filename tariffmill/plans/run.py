"""One refresh from end to end: codes, those due, their landed pages, records, catalogue, export."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tariffmill.operators.delta import keys_to_skip, run_counts
from tariffmill.patterns import DEFAULT_RULES, Rules
from tariffmill.plans.records import landed_of_codes, pages_to_fetch, records_from_pages
from tariffmill.plans.sync import sync_batch
from tariffmill.sources.sinks import export_catalogue
from tariffmill.sources.store import CatalogueStore


def refresh(
    codes: DataFrame, pages: DataFrame, store: CatalogueStore, source: str, batch_no: int, as_of: datetime,
    limit: int | None = None, force: bool = False, export_root: str | None = None, rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Load the landed pages of the codes that are due, and give the run's counts.

    Codes that the catalogue holds as refreshed lately are skipped unless forced; the limit holds for the others. The skip
    set is the store's before the run. With ``export_root`` all tables are exported afterwards.
    """
    skip = keys_to_skip(store, as_of, force=force)
    wanted = pages_to_fetch(codes, skip, limit)
    sync_batch(records_from_pages(landed_of_codes(pages, wanted)), store, source, batch_no, as_of, rules)
    if export_root:
        export_catalogue(store, export_root, rules)
    return run_counts(codes, skip)
