"""Read client over the canonical tables; every call returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.functions.scalars import minus_filled, to_int, to_long
from grantlake.functions.textsearch import any_of, find, rank
from grantlake.operators import grants as G

CONTRIBUTIONS = ("totacashcont", "totrevcuryea")


class Client:
    """``table`` gives a table by name; :meth:`at` reads Parquet tables below a folder."""

    def __init__(self, spark: SparkSession, table: Callable[[str], DataFrame]) -> None:
        self.spark, self.table = spark, table

    @classmethod
    def at(cls, spark: SparkSession, folder: str) -> Client:
        return cls(spark, lambda name: spark.read.parquet(f"{folder.rstrip('/')}/{name}"))

    def search_nonprofits(
        self, keywords: list[str], *, search_mode: str = "stemmed", return_text: bool = False, min_rank: float | None = None, limit: int | None = None,
        min_avg_contributions: float | None = None, min_avg_grants: float | None = None, min_num_grants: int | None = None, min_taxyear: int | None = None,
    ) -> DataFrame:
        """Hits with identity where there is one, best rank first, EIN on ties, found in the stored index. Filters by amounts
        need ``min_taxyear``."""
        query = any_of(keywords, search_mode)
        if min_taxyear is None and any(x is not None for x in (min_avg_contributions, min_avg_grants, min_num_grants)):
            raise ValueError("filters by amounts need min_taxyear")
        index = self.table("nonprofit_index_english" if search_mode == "stemmed" else "nonprofit_index_simple")
        hits = find(index, "ein", query).select("ein", rank(F.col("doc"), query).alias("rank"))
        if min_rank is not None:
            hits = hits.where(F.col("rank") >= min_rank)
        if min_avg_contributions is not None:
            rows = self.table("basic_fields").where(to_int(F.col("taxyear")) >= min_taxyear)
            hits = hits.join(G.min_avg(rows, "filerein", "taxyear", to_long(F.col("totacashcont")), min_avg_contributions), "ein", "left_semi")
        if min_avg_grants is not None or min_num_grants is not None:
            hits = hits.join(G.grant_eligible(self.table("unioned_grants"), "grantee", min_taxyear, min_avg_grants, min_num_grants), "ein", "left_semi")
        identity = self.table("nonprofit_canonical").select("ein", "name", "name_secondary", "city", "state")
        texts = self.table("nonprofit_text").select("ein", F.col("unique_text_compact").alias("unique_text"))
        hits = hits.join(texts, "ein", "left") if return_text else hits.withColumn("unique_text", F.lit(None).cast("string"))
        out = hits.join(identity, "ein", "left").select("ein", "name", "name_secondary", "city", "state", "rank", "unique_text").orderBy(F.col("rank").desc(), "ein")
        return out.limit(limit) if limit is not None else out

    def get_nonprofit(self, ein: str) -> DataFrame:
        text = self.table("nonprofit_text").select("ein", "unique_text_compact")
        return self.table("nonprofit_canonical").where(F.col("ein") == ein).join(text, "ein", "left")

    def get_basic_fields(self, eins: list[str], *, min_taxyear: int | None = None) -> DataFrame:
        rows = self.table("basic_fields").where(F.col("filerein").isin(list(eins)) if eins else F.lit(False))
        year, cash, public = to_int(F.col("taxyear")), to_long(F.col("totacashcont")), to_long(F.col("governgrants"))
        out = rows.select(
            F.col("filerein").alias("ein"), F.col("filername1").alias("name"), F.col("filername2").alias("name_secondary"), year.alias("taxyear"), F.col("filerus1").alias("addr_line_1"), F.col("filerus2").alias("addr_line_2"),
            F.col("fileruscity").alias("city"), F.col("filerusstate").alias("state"), F.col("fileruszip").alias("zip"), F.col("websitsiteit").alias("website"), to_long(F.col("totrevcuryea")).alias("total_revenue_current_year"),
            cash.alias("total_cash_contributions"), minus_filled(cash, public).alias("total_cash_contributions_no_gov"),
        )
        return out.where(F.col("taxyear") >= min_taxyear) if min_taxyear is not None else out

    def get_grants(self, eins: list[str], *, role: str = "grantee", min_taxyear: int | None = None) -> DataFrame:
        rows = G.for_eins(self.table("unioned_grants"), eins, role, min_taxyear)
        return G.with_granter_name(rows, self.table("nonprofit_canonical"), self.table("funder_canonical"))

    def get_grant_summaries(self, eins: list[str], *, role: str = "grantee", min_taxyear: int | None = None) -> DataFrame:
        rows = G.for_eins(self.table("unioned_grants"), eins, role, min_taxyear)
        return G.summaries_named(rows, self.table("nonprofit_canonical"), self.table("funder_canonical"), role)

    def find_eins_with_min_avg_contributions(self, eins: list[str], *, min_taxyear: int, min_avg: float, column: str = "totacashcont") -> DataFrame:
        if column not in CONTRIBUTIONS:
            raise ValueError(f"column must be one of {CONTRIBUTIONS}")
        rows = self.table("basic_fields").where((F.col("filerein").isin(list(eins)) if eins else F.lit(False)) & (to_int(F.col("taxyear")) >= min_taxyear))
        return G.min_avg(rows, "filerein", "taxyear", to_long(F.col(column)), min_avg).select("ein")
