"""Blocking keys of records: bags, in which a key may stand more than once."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T

RARE = "b_rare:"
#: Tokens that are sent to all tasks.
FREQUENT = 4096


@dataclass(frozen=True)
class Blocking:
    """What blocking does. profile "v1": hot keys are dropped, keys have plain weights; "v2": hot keys keep their first `cap` records, weights are discounted by frequency; "v2_disk": hot keys are dropped and the discount comes from the key's own records."""

    profile: str = "v1"
    families: str = "ABCD"
    cap: int = 100
    top_k: int = 50
    min_token: int = 3
    min_compact: int = 4
    domains: bool = True
    rare_tokens: bool = True
    leading_pairs: bool = True
    rare_most: int = 25
    drop_blank_keys: bool = False
    name_stopwords: tuple[str, ...] = C.NAME_STOPWORDS
    address_stopwords: tuple[str, ...] = C.ADDRESS_STOPWORDS

    @property
    def extended(self) -> bool:
        return self.profile != "v1"

    def only(self, families: str) -> Blocking:
        return replace(self, families=families)


V1 = Blocking()
V2 = Blocking(profile="v2", cap=150, top_k=120)


def _some(condition: Column, *keys: Column) -> Column:
    return F.when(condition, F.array(*keys)).otherwise(F.array().cast("array<string>"))


def _key(kind: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.concat_ws("_", *parts))


def _pairs(kind: str, left: Column, right: Column) -> Column:
    return F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: _key(kind, a, b))))


def _fields(df: DataFrame, config: Blocking) -> DataFrame:
    """The strings and lists that keys are made of, as columns of their own."""
    df = T.settle(df, **{f"_{c}": F.coalesce(F.trim(c), F.lit("")) for c in ("name_norm", "name_compact", "name_no_suffix", "domain_stem", "address_norm")})
    df = T.settle(df, _tokens=T.tokens(F.col("_name_norm")), _all=T.tokens(F.col("_address_norm")), _addressed=~F.coalesce("address_is_missing", F.lit(False)) & (F.col("_address_norm") != ""))
    clean = F.filter("_tokens", lambda t: (F.length(t) >= config.min_token) & ~t.isin(*config.name_stopwords))
    words = F.filter("_all", lambda t: (F.length(t) >= 4) & ~t.rlike(r"^\p{Nd}+$") & ~t.isin(*config.address_stopwords))
    if not config.extended:
        return T.settle(df, _clean=clean, _words=words, _nums=F.filter("_all", lambda t: t.rlike(r"^\p{Nd}+$")))

    def digits(t: Column) -> Column:
        bare = F.ltrim(t, F.lit("0"))
        whole = F.when((bare != "") & (bare != t), F.array(t, bare)).otherwise(F.array(t))
        return F.when(t.rlike(r"^\p{Nd}+$"), whole).otherwise(F.filter(F.regexp_extract_all(t, F.lit(r"(\p{Nd}+)")), lambda d: F.length(d) >= 2))

    low, raw = T.strip_accents(F.lower("_domain_stem")), F.coalesce(T.strip(F.col("business_name")), F.lit(""))
    plain = {"_raw": T.strip_accents(F.lower(raw)), "_plain": T.strip_accents(F.col("_name_norm")), "_plain_compact": T.strip_accents(F.col("_name_compact")), "_low": low}
    df = T.settle(df, _clean=clean, _words=words, _nums=F.array_distinct(F.flatten(F.transform("_all", digits))), _own=T.core_domain(raw), _of_stem=T.core_domain(F.col("_domain_stem")), **plain)
    fallback = F.struct(F.trim(F.regexp_replace("_low", "[-_.]+", " ")).alias("stem"), F.regexp_replace("_low", "[^a-z0-9]", "").alias("compact"))
    core = F.when((F.col("_own.compact") != "") | (F.col("_domain_stem") == ""), F.col("_own")).when(F.col("_of_stem.compact") != "", F.col("_of_stem")).otherwise(fallback)
    ends = F.array_distinct(F.concat(F.slice("_words", 1, 2), F.slice("_words", -2, 2)))
    return T.settle(df, _zips=F.filter("_nums", lambda t: F.length(t).isin(5, 6)), _chosen=F.when(F.size("_words") <= 4, F.col("_words")).otherwise(ends), _core=core, _raw=F.regexp_replace("_raw", "[^a-z0-9]", ""))


def key_array(config: Blocking) -> Column:
    """All keys but rare tokens, from the columns of _fields()."""
    c, on, long = F.col, set(config.families), config.min_compact
    compact_bare = F.replace(c("_name_no_suffix"), F.lit(" "), F.lit(""))
    number = F.get("_nums", F.lit(0))
    first, numbered = F.get("_clean", F.lit(0)), c("_addressed") & (F.size("_nums") > 0)
    keys: list[Column] = []
    if config.extended:
        keys.append(_some((F.length("_raw") >= long) & (c("_raw") != c("_name_compact")), _key("a_compact", c("_raw"))))
    if "A" in on:
        name, compact = F.length("_name_norm") >= long, F.length("_name_compact") >= long
        keys.append(_some(name, _key("a_exact", c("_name_norm"))))
        if config.extended:
            keys.append(_some(name & (c("_plain") != c("_name_norm")), _key("a_exact", c("_plain"))))
        keys.append(_some(compact, _key("a_compact", c("_name_compact"))))
        if config.extended:
            keys.append(_some(compact & (c("_plain_compact") != c("_name_compact")), _key("a_compact", c("_plain_compact"))))
        keys.append(_some(F.length("_name_no_suffix") >= long, _key("a_exact", c("_name_no_suffix")), _key("a_compact", compact_bare)))
        if not config.extended:
            keys.append(_some(F.coalesce("is_domain", F.lit(False)) & (F.length("_domain_stem") >= 3), _key("a_domain", c("_domain_stem")), _key("a_compact", c("_domain_stem"))))
        elif config.domains:
            keys.append(_some(F.length("_core.compact") >= 3, _key("a_compact", c("_core.compact")), _key("a_domain", c("_core.compact"))))
            keys.append(_some((F.length("_core.stem") >= 3) & (c("_core.stem") != c("_core.compact")), _key("a_exact", c("_core.stem"))))
    two = F.size("_tokens") >= 2
    if config.extended and config.leading_pairs:
        lead = [F.get("_tokens", F.lit(i)) for i in (0, 1)]
        keys.append(_some(two, _key("b_lead_bi", *lead)))
        keys.append(_some(two & (F.length(lead[0]) + F.length(lead[1]) >= 5), F.concat(F.lit("a_compact:"), *lead)))
    if "B" in on:
        keys.append(F.transform(F.slice("_clean", 1, 4 if config.extended else 3), lambda t: _key("b_tok", t)))
        keys.append(_some(F.size("_clean") >= 2, _key("b_bi", first, F.get("_clean", F.lit(1)))))
        if config.extended:
            keys.append(_some(F.size("_clean") >= 3, _key("b_bi", first, F.get("_clean", F.lit(2)))))
    none = F.array().cast("array<string>")
    if "C" in on:
        if config.extended:
            several = F.slice("_words", 2, 3)
            at = F.slice(F.zip_with(F.slice("_words", 1, 3), several, lambda a, b: F.when(b.isNotNull(), _key("c_addr_bi", a, b))), 1, 3)
            parts = [_pairs("c_num_w", F.slice("_nums", 1, 3), F.slice("_chosen", 1, 4)), _pairs("c_zip_w", F.slice("_zips", 1, 2), F.slice("_chosen", 1, 3)), F.filter(at, lambda k: k.isNotNull())]
        else:
            parts = [_pairs("c_num_w", F.slice("_nums", 1, 2), F.slice("_words", 1, 2))]
        keys += [F.when(c("_addressed"), p).otherwise(none) for p in parts]
    if "D" in on:
        keys.append(_some(numbered & (F.size("_clean") > 0), _key("d_name_num", first, number)))
        keys.append(_some(numbered & (F.length("_name_compact") >= 5), _key("d_pfx_num", F.substring("_name_compact", 1, 5), number)))
        if config.extended:
            keys.append(F.when(c("_addressed") & (F.size("_clean") > 0), F.transform(F.slice("_zips", 1, 2), lambda z: _key("d_zip_name", z, first))).otherwise(none))
    return F.concat(*keys)


def _clean_tokens(records: DataFrame, config: Blocking) -> DataFrame:
    """entity_id, pos, token: what _fields() calls _clean, without its other columns."""
    words = F.filter(T.tokens(F.coalesce(F.trim("name_norm"), F.lit(""))), lambda t: (F.length(t) >= config.min_token) & ~t.isin(*config.name_stopwords))
    return records.select("entity_id", F.posexplode(words).alias("pos", "token"))


def blocking_keys(records: DataFrame, config: Blocking = V1, vocabulary: DataFrame | None = None) -> DataFrame:
    """entity_id, tag (the key's family), key, pos. records: preprocessed. vocabulary: token, n; without it no record has rare-token keys."""
    fields = _fields(records, config)
    every = fields.select("entity_id", F.posexplode(key_array(config)).alias("pos", "key"))
    if config.extended and config.rare_tokens and "B" in config.families and vocabulary is not None:
        rare = vocabulary.where((F.col("n") > 1) & (F.col("n") <= config.rare_most)).select("token")
        # the commonest tokens, most of all occurrences, go before the shuffle; they are at most FREQUENT rows
        frequent = vocabulary.where(F.col("n") > config.rare_most).orderBy(F.desc("n"), "token").limit(FREQUENT).select("token")
        found = _clean_tokens(records, config).join(F.broadcast(frequent), "token", "left_anti").join(rare, "token")
        every = every.unionByName(found.select("entity_id", (F.col("pos") + 1000).alias("pos"), F.concat(F.lit(RARE), "token").alias("key")))
    if config.drop_blank_keys:
        every = every.where(F.trim(F.substring_index("key", ":", -1)) != "")
    return every.select("entity_id", F.upper(F.substring("key", 1, 1)).alias("tag"), "key", "pos")


def token_vocabulary(records: DataFrame, config: Blocking = V2) -> DataFrame:
    """token, n: occurrences in names, of tokens that aren't short or stopwords."""
    words = records.select(F.explode(T.tokens(F.coalesce("name_norm", F.lit("")))).alias("token"))
    return words.where((F.length("token") >= config.min_token) & ~F.col("token").isin(*config.name_stopwords)).groupBy("token").agg(F.count("*").alias("n"))
