"""Q5-Q7: multi-product flags, previous five products, repeat purchases."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import AccountCodes, Products, count_col, count_cols
from ..functions import days_between, flag
from ..operators.nearest import nearest_previous
from ..operators.ordered import previous_rows

N_PREVIOUS = 5


def project_flags(channelled: DataFrame) -> DataFrame:
    """Q5: counts plus 0/1 multi-product flags.

    ``orig_flag`` is prior total > 0; the window totals include the account
    itself, so their flags need > 1.
    """
    return channelled.select(
        "person", "id", "created", "contract_month", "product_type", "fico_score", "pcl_channel", *count_cols(),
        flag(F.col(count_col("tot", "orig")) > 0).alias("orig_flag"),
        flag(F.col(count_col("tot", "3month")) > 1).alias("post3m_flag"),
        flag(F.col(count_col("tot", "6month")) > 1).alias("post6m_flag"),
        flag(F.col(count_col("tot", "12month")) > 1).alias("post12m_flag"),
        flag(F.col(count_col("tot", "today")) > 1).alias("today_flag"),
    )


def account_rows(people: DataFrame, channelled: DataFrame | None, codes: AccountCodes = AccountCodes()) -> DataFrame:
    """The opened and issued accounts with their person, and contract month and channel where ``channelled`` has them.

    Without ``channelled``, ``people`` holds these accounts only, with ``contract_month`` and ``channel``.
    """
    if channelled is None:
        return people.select("person", "id", "created_at", "contract_month", "product_type", "channel")
    a = (people.filter(F.col("status").isin(codes.opened, codes.issued))
               .select("person", "id", "created_at", "product_type"))
    prod = channelled.select("id", "contract_month", F.col("pcl_channel").alias("channel"))
    return (a.join(prod, "id", "left")
             .select("person", "id", "created_at", "contract_month", "product_type", "channel"))


def previous_products(people: DataFrame, channelled: DataFrame | None = None, *, products: Products = Products(),
                      codes: AccountCodes = AccountCodes(), n: int = N_PREVIOUS) -> DataFrame:
    """Q6: for each opened/issued account, the person's previous ``n`` accounts.

    ``people`` is :func:`acctrail.plans.history.resolve_people`.
    Previous = earlier in (created_at, id) order within the person; accounts
    without a person form one group, as SQL windows do. ``channel`` and
    ``contract_month`` come from ``channelled`` (rows keyed by ``id`` with
    ``contract_month`` and ``pcl_channel``; present only for the accounts it
    covers), or from ``people`` itself (see :func:`account_rows`). Adds prev_prod{i}, prev_prod{i}_date, days_prod{i} (date
    boundaries crossed), channel_prev_prod{i}, and ``pcl_flag`` (any of the
    previous ``n`` is the PCL product).
    """
    prev = previous_rows(account_rows(people, channelled, codes), key="person", ts="created_at", tie="id",
                         cols=["product_type", "created_at", "channel"], n=n, prefix="_p")
    out = []
    for i in range(1, n + 1):
        p = F.col(f"_p{i}")
        out += [p["product_type"].alias(f"prev_prod{i}"),
                p["created_at"].alias(f"prev_prod{i}_date"),
                days_between("created_at", p["created_at"]).alias(f"days_prod{i}"),
                p["channel"].alias(f"channel_prev_prod{i}")]
    any_pcl = None
    for i in range(1, n + 1):
        hit = F.col(f"_p{i}")["product_type"] == F.lit(products.pcl)
        any_pcl = hit if any_pcl is None else (any_pcl | hit)
    return prev.select("person", "id", "created_at", "contract_month", "product_type", "channel",
                       *out, flag(any_pcl).alias("pcl_flag"))


def repeat_purchase(people: DataFrame, channelled: DataFrame | None = None, *, products: Products = Products(),
                    codes: AccountCodes = AccountCodes(), n: int = N_PREVIOUS) -> DataFrame:
    """Q7: PCL accounts with a PCL among the previous ``n``, and the nearest one.

    Inputs and order as in :func:`previous_products`. ``previous_product`` is 'prod{i} - <code>' where the nearest
    is ``i`` accounts back; ``days_diff_twopcl`` and ``prev_channel`` are its gap and channel.
    """
    rows = account_rows(people, channelled, codes).drop("contract_month")
    is_pcl = F.col("product_type") == F.lit(products.pcl)
    found = nearest_previous(rows, key="person", order=["created_at", "id"], pred=is_pcl,
                             cols=["created_at", "channel"], max_back=n)
    near = F.col("nearest")
    return (found.filter(is_pcl & near.isNotNull())
            .select("person", "id", "created_at", "product_type", "channel",
                    F.concat(F.lit("prod"), near["back"].cast("string"), F.lit(f" - {products.pcl}")).alias("previous_product"),
                    near["channel"].alias("prev_channel"),
                    days_between("created_at", near["created_at"]).alias("days_diff_twopcl")))
