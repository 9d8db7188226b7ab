"""The named jobs over one set of raw-layer tables.

``Tables`` bundles the five raw tables with the cleaning maps and the export
date; ``JOBS`` maps each job name to a function of it. The same registry
serves the command line (tables loaded from files) and the test catalog
(tables bound to the test data).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ledgerline.config import REFERENCE_CLEANING, Cleaning
from ledgerline.functions.cleaning import canonicalize_values
from ledgerline.operators import checks, crm_export, marts, postsale, presale, subscriptions


@dataclass
class Tables:
    accounts: DataFrame
    products: DataFrame
    sales_teams: DataFrame
    pipeline: DataFrame
    subscriptions_table: DataFrame | None = None
    external_ids: DataFrame | None = None
    cleaning: Cleaning = field(default_factory=lambda: REFERENCE_CLEANING)
    as_of: str | dt.date | None = None
    _derived: DataFrame | None = field(default=None, repr=False)

    @property
    def subscriptions(self) -> DataFrame:
        """The loaded subscriptions table, else derived from the Won deals (G1)."""
        if self.subscriptions_table is not None:
            return self.subscriptions_table
        if self._derived is None:
            self._derived = subscriptions.derive_subscriptions(self.pipeline)
        return self._derived

    def raw(self) -> dict[str, DataFrame]:
        return {"accounts": self.accounts, "products": self.products, "sales_teams": self.sales_teams,
                "sales_pipeline": self.pipeline, "subscriptions": self.subscriptions}

    def export_date(self) -> str | dt.date:
        return self.as_of if self.as_of is not None else dt.date.today()


def summary(t: Tables) -> DataFrame:
    c = t.cleaning
    return marts.pipeline_summary(t.pipeline, t.products, t.sales_teams, t.accounts, c.product, c.sector,
                                  c.location)


def scorecard(t: Tables) -> DataFrame:
    return marts.agent_scorecard(t.pipeline, t.sales_teams)


def retention(t: Tables) -> DataFrame:
    return marts.retention_summary(t.subscriptions, t.cleaning.product)


def opportunities(t: Tables) -> DataFrame:
    return crm_export.crm_opportunities(t.pipeline, t.products, t.cleaning.product, t.export_date())


def _ids(t: Tables) -> DataFrame:
    if t.external_ids is None:
        raise ValueError("this job needs the external id list (Name, Id)")
    return t.external_ids


def live_scorecard(t: Tables) -> DataFrame:
    """The scorecard as a plan alone: nothing runs until it is queried."""
    return marts.agent_scorecard(t.pipeline, t.sales_teams, live=True)


MARTS: dict[str, Callable[[Tables], DataFrame]] = {
    "vw_pipeline_summary": summary,
    "vw_agent_scorecard": scorecard,
    "vw_retention_summary": retention,
}

JOBS: dict[str, Callable[[Tables], DataFrame]] = {
    # cleaning
    "canonicalize_values": lambda t: canonicalize_values(
        t.accounts, {"sector": t.cleaning.sector, "office_location": t.cleaning.location}),
    # validation
    "validate_row_counts": lambda t: checks.row_counts({f"raw.{k}": v for k, v in t.raw().items()}),
    "orphans_by_stage": lambda t: checks.orphans_by_stage(t.pipeline),
    "closed_orphans": lambda t: checks.closed_orphans(t.pipeline),
    "unknown_accounts": lambda t: checks.unmatched_keys(t.pipeline, t.accounts, "account"),
    "unknown_products": lambda t: checks.unmatched_keys(t.pipeline, t.products, "product"),
    "product_match_status": lambda t: checks.product_match_status(t.pipeline, t.products),
    "null_audit_by_stage": lambda t: checks.null_audit_by_stage(t.pipeline),
    "duplicate_opportunity_ids": lambda t: checks.duplicate_keys(t.pipeline, ["opportunity_id"]),
    "near_duplicate_accounts": lambda t: checks.near_duplicate_names(t.accounts, "account"),
    "untraceable_subscriptions": lambda t: checks.untraceable_subscriptions(t.subscriptions, t.pipeline),
    # pre-sale
    "win_rate_overall": lambda t: presale.win_rate(t.pipeline),
    "win_rate_by_product": lambda t: presale.win_rate(t.pipeline, ["product"]),
    "win_rate_by_agent": lambda t: presale.win_rate(t.pipeline, ["sales_agent"]),
    "win_rate_by_manager": lambda t: presale.win_rate_by_team(t.pipeline, t.sales_teams, "manager"),
    "win_rate_by_region": lambda t: presale.win_rate_by_team(t.pipeline, t.sales_teams, "regional_office"),
    "sales_cycle_by_product": lambda t: presale.sales_cycle(t.pipeline, "product"),
    "sales_cycle_by_agent": lambda t: presale.sales_cycle(t.pipeline, "sales_agent"),
    "pipeline_velocity": lambda t: presale.pipeline_velocity(t.pipeline),
    "stage_snapshot": lambda t: presale.stage_snapshot(t.pipeline),
    "engaging_branch_rates": lambda t: presale.engaging_branch_rates(t.pipeline),
    "deal_size_by_product": lambda t: presale.deal_size_by_product(t.pipeline),
    "deal_size_by_sector": lambda t: presale.deal_size_by_sector(t.pipeline, t.accounts),
    "monthly_bookings": lambda t: presale.monthly_bookings(t.pipeline),
    "agent_quarter_rank": lambda t: presale.agent_quarter_rank(t.pipeline),
    "weighted_forecast": lambda t: presale.weighted_forecast(t.pipeline, t.products, t.cleaning.product),
    # post-sale
    "grr_nrr": lambda t: postsale.grr_nrr(t.subscriptions),
    "logo_churn": lambda t: postsale.logo_churn(t.subscriptions),
    "expansion_rate": lambda t: postsale.expansion_rate(t.subscriptions),
    "expansion_arr_by_product": lambda t: postsale.expansion_arr_by_product(t.subscriptions),
    "churn_by_sector": lambda t: postsale.churn_by_sector(t.subscriptions, t.accounts),
    "churn_by_size_quartile": lambda t: postsale.churn_by_size_quartile(t.subscriptions),
    "churn_by_agent_top": lambda t: postsale.churn_by_agent_top(t.subscriptions),
    # subscriptions
    "derive_subscriptions": lambda t: subscriptions.derive_subscriptions(t.pipeline),
    "sequential_subscription_ids": lambda t: subscriptions.number_subscriptions(
        subscriptions.derive_subscriptions(t.pipeline).select("opportunity_id")),
    "outcome_distribution": lambda t: subscriptions.outcome_distribution(t.subscriptions),
    "retention_sanity": lambda t: subscriptions.retention_sanity(t.subscriptions),
    "dropped_incomplete_won": lambda t: subscriptions.dropped_incomplete_won(t.pipeline),
    # marts
    "pipeline_summary": summary,
    "agent_scorecard": scorecard,
    "retention_summary": retention,
    "summary_row_count": lambda t: marts.summary_row_count(summary(t)),
    "distinct_products": lambda t: marts.distinct_products(summary(t)),
    "retention_headline": lambda t: marts.retention_headline(retention(t)),
    # CRM export
    "crm_accounts": lambda t: crm_export.crm_accounts(t.accounts, t.cleaning.sector, t.cleaning.crm_country),
    "crm_opportunities": opportunities,
    "export_reconciliation": lambda t: crm_export.export_reconciliation(t.pipeline, opportunities(t)),
    "export_stage_distribution": lambda t: crm_export.value_distribution(opportunities(t), "Stage"),
    "placeholder_counts": lambda t: crm_export.placeholder_counts(t.pipeline),
    "export_product_distribution": lambda t: crm_export.value_distribution(opportunities(t), "Product"),
    "attach_external_ids": lambda t: crm_export.attach_external_ids(opportunities(t), _ids(t)),
    "id_match_audit": lambda t: crm_export.id_match_audit(opportunities(t), _ids(t)),
    "names_with_several_ids": lambda t: crm_export.names_with_several_ids(opportunities(t), _ids(t)),
    "unmatched_sample": lambda t: crm_export.unmatched_sample(opportunities(t), _ids(t)),
}
