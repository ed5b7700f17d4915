"""Which staging rows a migration takes, and how it maps them.

The reference ships five migration scripts that differ only in selection and a
few switches; here they are five values of one ``Policy``. Every selection is a
left-semi join (EXISTS / IN), disjunctions are a semi join against the union of
the key sets, and the category test is an ``isin`` that Catalyst pushes into
the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderfold import codes

KEY = "numeroseao"


@dataclass(frozen=True)
class Policy:
    name: str
    notices: str            # 'cat_and_contract' | 'cat_and_contract_or_expense' | 'contract_or_expense' | 'all'
    contracts: str          # 'notice_in_cat' | 'notice_in_cat_or_expense' | 'notice_or_expense' | 'all'
    expenses: str           # 'notice_in_cat_and_contract' | 'notice_in_cat_or_contract' | 'notice_or_contract' | 'all'
    notice_categories: tuple = tuple(codes.CONSTRUCTION_NOTICE_CATEGORIES)
    contract_categories: tuple = tuple(codes.CONSTRUCTION_CONTRACT_CATEGORIES)
    build_awards: bool = False
    swap_dates: bool = True
    stub_releases: bool = False
    clear_history: bool = False
    bid_unit_blank_is_missing: bool = False   # NULL, '' and 0 -> CAD (first script) vs NULL only


CONSTRUCTION_WITH_CONTRACTS = Policy("construction_with_contracts", "cat_and_contract", "notice_in_cat",
                                     "notice_in_cat_and_contract", build_awards=True, clear_history=True,
                                     bid_unit_blank_is_missing=True)
CONSTRUCTION_NO_AWARDS = Policy("construction_no_awards", "cat_and_contract", "notice_in_cat",
                                "notice_in_cat_and_contract", clear_history=True)
CONSTRUCTION_CONTRACT_OR_EXPENSE = Policy(
    "construction_contract_or_expense", "cat_and_contract_or_expense", "notice_in_cat_or_expense",
    "notice_in_cat_or_contract", notice_categories=tuple(codes.CONSTRUCTION_CONTRACT_CATEGORIES),
    stub_releases=True)
RELATED_ONLY = Policy("related_only", "contract_or_expense", "notice_or_expense", "notice_or_contract",
                      swap_dates=False, stub_releases=True)
ALL_DATA = Policy("all_data", "all", "all", "all", swap_dates=False, stub_releases=True)


def _keys(df: DataFrame) -> DataFrame:
    return df.select(KEY).where(F.col(KEY).isNotNull())


def _any_of(*key_sets: DataFrame) -> DataFrame:
    out = key_sets[0]
    for k in key_sets[1:]:
        out = out.unionByName(k)
    return out


def _semi(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys, KEY, "left_semi")


def select_staging(policy: Policy, avis: DataFrame, contrats: DataFrame,
                   depenses: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Return the (notices, contracts, expenses) a migration under ``policy`` reads."""
    k_contract, k_expense, k_notice = _keys(contrats), _keys(depenses), _keys(avis)
    notice_cat = avis.where(F.col("categorieseao").isin(list(policy.notice_categories)))
    k_cat = _keys(avis.where(F.col("categorieseao").isin(list(policy.contract_categories))))

    notices = {
        "cat_and_contract": lambda: _semi(notice_cat, k_contract),
        "cat_and_contract_or_expense": lambda: _semi(notice_cat, _any_of(k_contract, k_expense)),
        "contract_or_expense": lambda: _semi(avis, _any_of(k_contract, k_expense)),
        "all": lambda: avis,
    }[policy.notices]()
    contracts = {
        "notice_in_cat": lambda: _semi(contrats, k_cat),
        "notice_in_cat_or_expense": lambda: _semi(contrats, _any_of(k_cat, k_expense)),
        "notice_or_expense": lambda: _semi(contrats, _any_of(k_notice, k_expense)),
        "all": lambda: contrats,
    }[policy.contracts]()
    expenses = {
        "notice_in_cat_and_contract": lambda: _semi(depenses, _semi(k_cat, k_contract)),
        "notice_in_cat_or_contract": lambda: _semi(depenses, _any_of(k_cat, k_contract)),
        "notice_or_contract": lambda: _semi(depenses, _any_of(k_notice, k_contract)),
        "all": lambda: depenses,
    }[policy.expenses]()
    return notices, contracts, expenses


def stub_releases(notices: DataFrame, contracts: DataFrame, expenses: DataFrame) -> DataFrame:
    """P20: a bare release for each selected contract/expense key without a selected
    notice. Contracts are migrated before expenses, so a key orphaned in both gets
    the contract tag."""
    k_notice = _keys(notices)
    orphan_c = _keys(contracts).distinct().join(k_notice, KEY, "left_anti").withColumn("tag", F.lit("contrat"))
    orphan_d = (_keys(expenses).distinct().join(k_notice, KEY, "left_anti")
                .join(orphan_c.select(KEY), KEY, "left_anti").withColumn("tag", F.lit("depense")))
    ocid = F.concat(F.lit(codes.OCID_PREFIX), F.col(KEY))
    return orphan_c.unionByName(orphan_d).select(ocid.alias("ocid"), ocid.alias("release_id"), "tag")
