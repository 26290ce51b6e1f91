"""Q1-Q3: the account history extract and the per-account product counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import ZONE_PST_FIXED, AccountCodes, Products
from ..functions import local_date
from ..operators.joins import left_join
from ..operators.ordered import product_history_counts
from ..sources.roles import Roles


PEOPLE_COLUMNS = ["id", "created_at", "product_type", "status", "program", "program_code",
                  "fico_score", "lap_id", "borrower_id", "initiator", "person"]


def resolve_people(accounts: DataFrame, applications: DataFrame, borrowers: DataFrame) -> DataFrame:
    """Every account with its application and its person, one row per account.

    ``accounts`` left join ``applications`` on id (``lap_id`` is the
    application's id, NULL when there is none), left join ``borrowers`` on the
    application's borrower; an account without a borrower keeps a NULL person.
    Many stages read this; the pipeline builds it once.
    """
    a = accounts.select("id", "created_at", "product_type", "status", "program", "program_code",
                        "fico_score")
    ap = applications.select("id", F.col("id").alias("lap_id"), "borrower_id", "initiator")
    b = borrowers.select(F.col("id").alias("_b_id"), "person")
    # accounts without an application have a NULL borrower: spread, not piled up
    return left_join(a.join(ap, "id", "left"), b, "borrower_id", "_b_id", salt="id").select(*PEOPLE_COLUMNS)


def account_history(people: DataFrame, *, codes: AccountCodes = AccountCodes(),
                    zone: str = ZONE_PST_FIXED, carry: Sequence[str] = ()) -> DataFrame:
    """Q1: opened/issued accounts with their person and local creation date.

    Output: person, id, created (DATE in ``zone``), product_type, and the columns of ``people`` named in ``carry``.
    """
    return (people.filter(F.col("status").isin(codes.opened, codes.issued))
                  .select("person", "id", local_date("created_at", zone).alias("created"), "product_type", *carry))


def history_from_roles(r: Roles, codes: AccountCodes = AccountCodes()) -> DataFrame:
    return account_history(resolve_people(r.accounts, r.applications, r.borrowers), codes=codes)


def product_history(history: DataFrame, *, as_of, products: Products = Products()) -> DataFrame:
    """Q2: the 25 product-history counts per account."""
    return product_history_counts(history, as_of=as_of, products=products)


def keep_product(df: DataFrame, product_code: str, column: str = "product_type") -> DataFrame:
    """Q3: rows of one product type."""
    return df.filter(F.col(column) == F.lit(product_code))
