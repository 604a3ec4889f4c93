"""Normalised columns of entity records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T

DERIVED = ("name_norm", "name_compact", "name_no_suffix", "legal_suffix", "has_legal_suffix", "is_domain", "domain_stem", "name_script", "address_norm", "address_is_missing", "address_order_indep", "address_script", "country_norm")


def preprocess_names(df: DataFrame, forms=C.LEGAL_FORMS) -> DataFrame:
    """Adds the eight columns that come from business_name."""
    raw = F.col("business_name")
    df = T.settle(df, _u=F.when(~T.is_missing(raw), T.strip(T.nfkc(raw))))
    df = T.settle(df, domain_stem=T.domain_stem(F.col("_u")), name_norm=T.clean(T.spell_and(F.lower("_u"))))
    df = T.settle(df, _target=T.strip(T.without_url(F.col("_u"), F.col("domain_stem"))))
    df = T.settle(df, _form=F.split(T.legal_form(F.col("_target"), forms), T.CUT))
    bare = F.coalesce(F.col("_form")[1], F.col("_target"))
    return (
        df.withColumn("name_compact", F.replace("name_norm", F.lit(" "), F.lit("")))
        .withColumn("name_no_suffix", T.clean(T.spell_and(F.lower(bare))))
        .withColumn("legal_suffix", F.col("_form")[0])
        .withColumn("has_legal_suffix", F.col("_form").isNotNull())
        .withColumn("is_domain", F.col("domain_stem").isNotNull())
        .withColumn("name_script", F.when(F.col("_u").isNull(), "unknown").otherwise(T.detect_script(F.col("_u"))))
        .drop("_u", "_target", "_form")
    )


def preprocess_addresses(df: DataFrame, abbreviations: dict[str, str] = C.ADDRESS_ABBREVIATIONS) -> DataFrame:
    """Adds the four columns that come from business_address."""
    raw = F.col("business_address")
    df = T.settle(df, _u=F.when(~T.is_missing(raw), T.strip(T.nfkc(raw))))
    df = T.settle(df, _t=T.address_tokens(F.lower("_u"), abbreviations))
    some = F.size("_t") > 0
    return (
        df.withColumn("address_norm", F.when(some, F.array_join("_t", " ")))
        .withColumn("address_is_missing", ~F.coalesce(some, F.lit(False)))
        .withColumn("address_order_indep", F.when(some, F.array_join(F.array_sort("_t"), " ")))
        .withColumn("address_script", F.when(F.col("_u").isNull(), "unknown").otherwise(T.detect_script(F.col("_u"))))
        .drop("_u", "_t")
    )


def preprocess(df: DataFrame, forms=C.LEGAL_FORMS, abbreviations: dict[str, str] = C.ADDRESS_ABBREVIATIONS) -> DataFrame:
    """Adds DERIVED; columns whose source column is absent are left out."""
    if "business_name" in df.columns:
        df = preprocess_names(df, forms)
    if "business_address" in df.columns:
        df = preprocess_addresses(df, abbreviations)
    if "country" in df.columns:
        df = df.withColumn("country_norm", T.normalise_country(F.col("country")))
    return df
