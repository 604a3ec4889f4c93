"""Features of enriched pairs: 21 of the basic and 34 of the extended profile."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T

BASIC = (
    "name_exact_match name_compact_exact_match name_no_suffix_match name_token_jaccard name_token_overlap_count name_levenshtein_sim name_compact_levenshtein_sim legal_suffix_match domain_stem_match script_match "
    "address_exact_match address_token_jaccard address_token_overlap_count address_number_match address_levenshtein_sim address_missing_either country_exact_match country_missing_either source_is_s2 name_len_diff_ratio address_len_diff_ratio"
).split()
EXTRA = (
    "name_token_count_diff name_token_containment name_idf_jaccard name_char_3gram_jaccard name_acronym_match address_number_conflict address_postal_match address_char_3gram_jaccard domain_core_exact_match domain_core_jaccard "
    "country_one_sided_missing source_is_s3 source_s3_domain_stem_interaction"
).split()
EXTENDED = [*BASIC, *EXTRA]
UNFITTED_IDF = 5.0


def token_idf(records: DataFrame, name_column: str = "name_norm", least: int = 2) -> DataFrame:
    """token, df, idf = ln(1 + (n + 1) / (df + 1)): of tokens of two or more characters, counted once a record."""
    words = records.select(F.explode(F.array_distinct(T.tokens(F.coalesce(name_column, F.lit(""))))).alias("token")).where(F.length("token") >= least)
    n = records.agg(F.count("*").alias("n_records"))
    return words.groupBy("token").agg(F.count("*").alias("df")).join(F.broadcast(n)).select("token", "df", F.log(1 + (F.col("n_records") + 1) / (F.col("df") + 1)).alias("idf"))


def default_idf(n_records: int) -> float:
    """Of a token that no record has."""
    return math.log(1 + (n_records + 1))


def with_weights(records: DataFrame, idf: DataFrame, id_column: str = "entity_id", name_column: str = "name_norm") -> DataFrame:
    """records with idf_weights: a map of the weights of the name's tokens. Each record's tokens meet the table once, however many pairs the record is in."""
    words = records.select(id_column, F.explode(F.array_distinct(T.tokens(F.coalesce(name_column, F.lit(""))))).alias("token"))
    found = words.join(idf.select("token", "idf"), "token").groupBy(id_column).agg(F.map_from_entries(F.collect_list(F.struct("token", "idf"))).alias("idf_weights"))
    return records.join(found, id_column, "left").withColumn("idf_weights", F.coalesce("idf_weights", F.create_map().cast("map<string,double>")))


def _text(name: str, trimmed: bool) -> Column:
    x = F.coalesce(name, F.lit(""))
    return T.strip(x) if trimmed else x


def feature_columns(extended: bool = False, default: float = UNFITTED_IDF) -> dict[str, Column]:
    """By name. The extended ones need what extended_records() adds to both sides."""
    side = {p: {c: _text(f"{p}_{c}", extended) for c in ("name_norm", "name_compact", "name_no_suffix", "address_norm", "country_norm")} for p in ("s1", "cand")}
    (a, b), flag = (side["s1"], side["cand"]), S.flag
    missing = F.lit(False)
    for p in ("s1", "cand"):
        missing = missing | F.coalesce(f"{p}_address_is_missing", F.lit(False)) | (side[p]["address_norm"] == "")
    edit = S.quick_edit_similarity if extended else S.edit_similarity

    def same(c: str) -> Column:
        return flag((a[c] != "") & (a[c] == b[c]))

    def addressed(value: Column, otherwise: float = 0.0) -> Column:
        return F.when(missing, otherwise).otherwise(value)

    no_country = ("", "nan", "none", "null") if extended else ("", "nan")
    country = [F.lower(x["country_norm"]) if extended else x["country_norm"] for x in (a, b)]
    known = [~c.isin(*no_country) for c in country]
    suffix = [F.when(F.col(f"{p}_legal_suffix") != "", F.col(f"{p}_legal_suffix")) for p in ("s1", "cand")]
    script = [F.coalesce(f"{p}_script", F.lit("unknown")) for p in ("s1", "cand")]
    stem = F.coalesce("cand_domain_stem", F.lit(""))
    stem_match = S.stem_match(a["name_norm"], stem, F.coalesce("cand_is_domain", F.lit(False)))
    is_s2 = (F.col("cand_source") == "S2") | (F.col("candidate_id").startswith("S2") if extended else F.contains("candidate_id", F.lit("S2-")))
    out = {
        "name_exact_match": same("name_norm"),
        "name_compact_exact_match": same("name_compact"),
        "name_no_suffix_match": same("name_no_suffix"),
        "name_token_jaccard": S.token_jaccard(a["name_norm"], b["name_norm"]),
        "name_token_overlap_count": S.token_overlap(a["name_norm"], b["name_norm"]),
        "name_levenshtein_sim": edit(a["name_norm"], b["name_norm"]),
        "name_compact_levenshtein_sim": edit(a["name_compact"], b["name_compact"]),
        "legal_suffix_match": F.when(suffix[0].isNotNull() & suffix[1].isNotNull(), flag(suffix[0] == suffix[1])).when(suffix[0].isNotNull() | suffix[1].isNotNull(), 0.0).otherwise(-1.0),
        "domain_stem_match": stem_match,
        "script_match": flag((script[0] != "unknown") & (script[0] == script[1])),
        "address_exact_match": addressed(flag(a["address_norm"] == b["address_norm"])),
        "address_token_jaccard": addressed(S.token_jaccard(a["address_norm"], b["address_norm"])),
        "address_token_overlap_count": addressed(S.token_overlap(a["address_norm"], b["address_norm"])),
        "address_number_match": addressed(S.number_match(a["address_norm"], b["address_norm"]), -1.0),
        "address_levenshtein_sim": addressed(edit(a["address_norm"], b["address_norm"])),
        "address_missing_either": flag(missing),
        "country_exact_match": F.when(known[0] & known[1], flag(F.lower(country[0]) == F.lower(country[1]))).otherwise(-1.0),
        "country_missing_either": flag(~(known[0] & known[1])),
        "source_is_s2": flag(is_s2),
        "name_len_diff_ratio": S.length_ratio(a["name_norm"], b["name_norm"]),
        "address_len_diff_ratio": S.length_ratio(a["address_norm"], b["address_norm"]),
    }
    if extended:
        words = [T.tokens(x["name_norm"]) for x in (a, b)]
        short = [S.acronym(w) for w in words]
        told = [F.length(s) >= 2 for s in short]
        acronym = (told[0] & ((short[0] == b["name_compact"]) | (short[0] == b["name_norm"]))) | (told[1] & ((short[1] == a["name_compact"]) | (short[1] == a["name_norm"]))) | (told[0] & told[1] & (short[0] == short[1]))
        core, plain = F.col("cand_domain_core"), F.col("s1_plain_compact")
        is_s3 = flag((F.col("cand_source") == "S3") | F.col("candidate_id").startswith("S3"))
        number = S.number_match(a["address_norm"], b["address_norm"])
        out |= {
            "name_token_count_diff": F.abs(F.size(words[0]) - F.size(words[1])),
            "name_token_containment": flag((F.size(words[0]) > 0) & (F.size(words[1]) > 0) & ((F.size(F.array_except(*words)) == 0) | (F.size(F.array_except(*words[::-1])) == 0))),
            "name_idf_jaccard": S.weighted_jaccard(F.array_distinct(words[0]), F.array_distinct(words[1]), [F.col("s1_idf_weights"), F.col("cand_idf_weights")], default),
            "name_char_3gram_jaccard": S.gram_jaccard(a["name_compact"], b["name_compact"]),
            "name_acronym_match": flag(acronym),
            "address_number_conflict": addressed(flag(number == 0.0)),
            "address_postal_match": addressed(F.when(number < 0, -1.0).otherwise(S.postal_match(a["address_norm"], b["address_norm"])), -1.0),
            "address_char_3gram_jaccard": addressed(S.gram_jaccard(a["address_norm"], b["address_norm"])),
            "domain_core_exact_match": flag((core != "") & (F.contains(plain, core) | F.contains(core, plain))),
            "domain_core_jaccard": F.when(core == "", 0.0).otherwise(S.gram_jaccard(plain, core)),
            "country_one_sided_missing": flag(known[0] != known[1]),
            "source_is_s3": is_s3,
            "source_s3_domain_stem_interaction": is_s3 * stem_match,
        }
    return out


def with_cores(records: DataFrame) -> DataFrame:
    """records with domain_core (of the name or the domain's stem) and plain_compact (the compact name's base letters), once a record."""
    stem, name = F.coalesce("domain_stem", F.lit("")), T.strip(F.coalesce("name_norm", F.lit("")))
    letters = F.regexp_replace(T.strip_accents(F.lower(stem)), "[^a-z0-9]", "")
    rows = T.settle(records, _own=T.core_domain(name)["compact"], _stem=T.core_domain(stem)["compact"], _letters=letters, plain_compact=T.strip_accents(T.strip(F.coalesce("name_compact", F.lit("")))))
    core = F.when(F.col("_own") != "", F.col("_own")).when(F.col("_stem") != "", F.col("_stem")).otherwise(F.col("_letters"))
    return rows.withColumn("domain_core", core).drop("_own", "_stem", "_letters")


def extended_records(records: DataFrame, idf: DataFrame | None = None) -> DataFrame:
    """records with what the extended features need of each side; idf: token weights, without which all tokens weigh alike."""
    rows = with_cores(records)
    return rows if idf is None else with_weights(rows, idf)


def _enriched(pairs: DataFrame) -> DataFrame:
    missing = [c for side in ("s1", "cand") for c in (f"{side}_name_norm", f"{side}_address_norm", f"{side}_country_norm") if c not in pairs.columns]
    if missing:
        raise ValueError(f"pairs have no columns {missing}; enrich them from both sides' records first")
    return pairs


def basic_features(pairs: DataFrame) -> DataFrame:
    """pairs: enriched. Its ids, label if it has one, and BASIC as doubles."""
    pairs = _enriched(pairs)
    kept = [c for c in ("s1_id", "candidate_id", "label") if c in pairs.columns]
    return pairs.select(*kept, *[x.cast("double").alias(n) for n, x in feature_columns().items()])


def extended_features(pairs: DataFrame, default: float = UNFITTED_IDF) -> DataFrame:
    """The same with EXTENDED as floats. pairs: enriched from extended_records() of both sides. Tokens weigh what their record's idf_weights say, or `default`."""
    pairs = _enriched(pairs)
    kept = [c for c in ("s1_id", "candidate_id", "label") if c in pairs.columns]
    for c in ("s1_idf_weights", "cand_idf_weights"):
        if c not in pairs.columns:
            pairs = pairs.withColumn(c, F.create_map().cast("map<string,double>"))
    return pairs.select(*kept, *[x.cast("float").alias(n) for n, x in feature_columns(True, default).items()])
