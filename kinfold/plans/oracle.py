"""The registered queries once more, as DuckDB SQL over the same tables."""

from __future__ import annotations

from ..functions import constants as C
from ..functions.text import legal_patterns
from ..sources.tables import VIEWS

THRESHOLDS = [round(0.05 * i, 2) for i in range(1, 20)]
KS = (1, 2, 5, 10, 20, 50)


def text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def texts(values) -> str:
    return ", ".join(map(text, values))


def mapping(table: dict[str, str]) -> str:
    return "map {" + ", ".join(f"{text(k)}: {text(v)}" for k, v in table.items()) + "}"


def _legal() -> str:
    edge = text(" ,.-_")
    found = lambda canon, rest: f"{text(canon)} || chr(1) || nullif(trim({rest}, {edge}), '')"
    extract = lambda pattern, group=1: f"regexp_extract(target, {text('(?is)' + pattern)}, {group})"
    steps = [found("pvt_ltd", extract(r"^\s*(?:pvt\.?|private)\s+(.*?)\s+(?:ltd\.?|limited)\.?\s*$"))]
    patterns = legal_patterns()
    steps += [found(c, extract(end)) for c, end, _, _ in patterns]
    steps += [found(c, extract(start)) for c, _, start, _ in patterns]
    steps += [f"case when regexp_matches(target, {text('(?is)' + inside)}) then {found(c, f'''regexp_replace({extract(inside)} || ' ' || {extract(inside, 2)}, '\\s+', ' ', 'g')''')} end" for c, _, _, inside in patterns]
    return "coalesce(" + ",\n ".join(steps) + ")"


def _clean(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g'))"


def _tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


DOMAIN = C.DOMAIN
PIPED = rf"(?i)\s*\|\s*(?:https?://)?(?:www\.)?[a-zA-Z0-9][a-zA-Z0-9.-]*\.(?:{C.TLDS})\S*"


def core_domain(x: str) -> dict[str, str]:
    """CTE bodies' expressions: stem and compact of a column without pipes, of ASCII text."""
    tld = rf"\.(?:{C.EXTENDED_TLDS})\b"
    low = f"lower(trim({x}))"
    shown = f"(regexp_matches({low}, '^https?://') or regexp_matches({low}, '\\bwww\\d*\\.') or regexp_matches({low}, {text(tld)}))"
    host = f"regexp_extract(regexp_replace({low}, '^(?:https?://)?(?:www\\d*\\.)?', ''), '^([^:/?#\\s]*)', 1)"
    bare = f"trim(regexp_replace({host}, {text(tld)}, '', 'g'), '.-_ ')"
    labels = f"list_filter(string_split({bare}, '.'), lambda p: p <> '')"
    telling = f"list_filter({labels}, lambda p: p not in ({texts(C.SUBDOMAINS)}))"
    core = f"case when len({labels}) > 1 then coalesce(({telling})[-1], ({labels})[-1]) else {bare} end"
    compact = f"regexp_replace({core}, '[^a-z0-9]', '', 'g')"
    good = f"coalesce({shown} and length({compact}) >= 2, false)"
    return {"stem": f"case when {good} then trim(regexp_replace({core}, '[-_.]+', ' ', 'g')) else '' end", "compact": f"case when {good} then {compact} else '' end"}


MISSING = "({0} is null or lower(trim({0})) in (" + texts(C.NULL_LITERALS) + "))"

BASE: list[tuple[str, str]] = [
    *VIEWS.items(),
    ("raw", "select *, 'S1' as source from s1 union all select *, 'S2' from s2 union all select *, 'S3' from s3"),
    ("p0", f"select *, case when not {MISSING.format('business_name')} then trim(business_name) end as u, case when not {MISSING.format('business_address')} then lower(trim(business_address)) end as a from raw"),
    ("p1", f"select *, lower(u) as lowered, case when regexp_matches(u, {text(DOMAIN)}) then regexp_replace(regexp_replace(lower(regexp_extract(u, {text(DOMAIN)}, 1)), '^www\\.', ''), '\\.(?:{C.TLDS})$', '') end as labels from p0"),
    ("p2", "select *, case when len(string_split(labels, '.')) > 1 and string_split(labels, '.')[-1] not in ('co', 'com') then string_split(labels, '.')[-1] else string_split(labels, '.')[1] end as domain_stem from p1"),
    ("p3", f"select *, case when domain_stem is null then u else coalesce(nullif(trim(regexp_replace(u, {text(PIPED)}, '', 'g'), ' |,.-_'), ''), nullif(trim(regexp_replace(domain_stem, '[-_.]', ' ', 'g')), ''), u) end as target from p2"),
    ("p4", f"select *, {_legal()} as form from p3"),
    ("p5", f"select *, list_transform(list_filter({_tokens(_clean(r'''regexp_replace(a, '\bp\.?\s*o\.?\s*box\b', 'pobox', 'g')'''))}, lambda t: t not in ({texts(C.ADDRESS_NULL_TOKENS)})), lambda t: coalesce({mapping(C.ADDRESS_ABBREVIATIONS)}[t], t)) as wa from p4"),
    (
        "pre",
        f"""select entity_id, source, business_name, business_address, country, {_clean("replace(lowered, '&', ' and ')")} as name_norm, replace({_clean("replace(lowered, '&', ' and ')")}, ' ', '') as name_compact,
 {_clean("replace(lower(coalesce(string_split(form, chr(1))[2], target)), '&', ' and ')")} as name_no_suffix, string_split(form, chr(1))[1] as legal_suffix, form is not null as has_legal_suffix, domain_stem is not null as is_domain, domain_stem,
 case when u is null or not regexp_matches(u, '[A-Za-z]') then 'unknown' else 'latin' end as name_script,
 case when len(wa) > 0 then array_to_string(wa, ' ') end as address_norm, not coalesce(len(wa) > 0, false) as address_is_missing, case when len(wa) > 0 then array_to_string(list_sort(wa), ' ') end as address_order_indep,
 case when {MISSING.format("country")} then '' else coalesce({mapping(C.COUNTRIES)}[lower(trim(country))], case when length(trim(country)) <= 3 then upper(trim(country)) else trim(country) end) end as country_norm from p5""",
    ),
    ("gt1", "select source1_entity_id as s1_id, list_sort(list_distinct(list_filter(string_split(matched_entity_ids, ','), lambda x: x <> ''))) as ids from gt"),
    ("truth", "select s1_id, unnest(ids) as candidate_id from gt1"),
]


def _pairs(kind: str, left: str, right: str) -> str:
    return f"flatten(list_transform({left}, lambda x: list_transform({right}, lambda y: '{kind}:' || x || '_' || y)))"


def _when(condition: str, *keys: str) -> str:
    return f"case when {condition} then [{', '.join(keys)}] else [] end"


STOP = f"({texts(C.NAME_STOPWORDS)})"
KEYS_V1: list[tuple[str, str]] = [
    (
        "k0",
        f"""select entity_id, source, coalesce(name_norm, '') as nn, coalesce(name_compact, '') as nc, coalesce(name_no_suffix, '') as ns, is_domain, coalesce(domain_stem, '') as ds,
 list_filter({_tokens("coalesce(name_norm, '')")}, lambda t: length(t) >= 3 and t not in {STOP}) as ct, {_tokens("coalesce(address_norm, '')")} as aw from pre""",
    ),
    ("k1", f"select *, list_filter(aw, lambda t: regexp_matches(t, '^[0-9]+$')) as nums, list_filter(aw, lambda t: length(t) >= 4 and not regexp_matches(t, '^[0-9]+$') and t not in ({texts(C.ADDRESS_STOPWORDS)})) as words from k0"),
]


def keys_v1(families: str = "ABCD") -> list[tuple[str, str]]:
    parts = {
        "A": [_when("length(nn) >= 4", "'a_exact:' || nn"), _when("length(nc) >= 4", "'a_compact:' || nc"), _when("length(ns) >= 4", "'a_exact:' || ns", "'a_compact:' || replace(ns, ' ', '')"), _when("is_domain and length(ds) >= 3", "'a_domain:' || ds", "'a_compact:' || ds")],
        "B": ["list_transform(ct[1:3], lambda t: 'b_tok:' || t)", _when("len(ct) >= 2", "'b_bi:' || ct[1] || '_' || ct[2]")],
        "C": [_pairs("c_num_w", "nums[1:2]", "words[1:2]")],
        "D": [_when("len(nums) > 0 and len(ct) > 0", "'d_name_num:' || ct[1] || '_' || nums[1]"), _when("len(nums) > 0 and length(nc) >= 5", "'d_pfx_num:' || nc[1:5] || '_' || nums[1]")],
    }
    every = " || ".join(p for f in families for p in parts[f])
    return [*KEYS_V1, ("keys", f"select entity_id, source, upper(key[1:1]) as tag, key, pos from (select entity_id, source, unnest(ks) as key, unnest(range(len(ks))) as pos from (select entity_id, source, {every} as ks from k1))")]


CANDIDATES_V1: list[tuple[str, str]] = [
    ("hist", "select key, count(*) as n from keys where source <> 'S1' group by key"),
    ("scored", "select q.entity_id as s1_id, p.entity_id as candidate_id, cast(sum(case q.tag when 'A' then 3 when 'D' then 2 else 1 end) as double) as score from keys q join keys p using (key) join hist using (key) where q.source = 'S1' and p.source <> 'S1' and n < 100 group by all"),
    ("cand", "select * from (select *, cast(row_number() over (partition by s1_id order by score desc, candidate_id) as integer) as rnk from scored) where rnk <= 50"),
]

_own, _of_stem = core_domain("coalesce(business_name, '')"), core_domain("coalesce(domain_stem, '')")
KEYS_V2: list[tuple[str, str]] = [
    ("vocab", f"select token, count(*) as n from (select unnest({_tokens('name_norm')}) as token from pre) where length(token) >= 3 and token not in {STOP} group by token"),
    (
        "w0",
        f"""select entity_id, source, coalesce(name_norm, '') as nn, coalesce(name_compact, '') as nc, coalesce(name_no_suffix, '') as ns, coalesce(domain_stem, '') as ds, regexp_replace(lower(coalesce(business_name, '')), '[^a-z0-9]', '', 'g') as rc,
 {_own["stem"]} as s0, {_own["compact"]} as c0, {_of_stem["stem"]} as s1, {_of_stem["compact"]} as c1, {_tokens("coalesce(name_norm, '')")} as tk, {_tokens("coalesce(address_norm, '')")} as aw from pre""",
    ),
    (
        "w1",
        f"""select *, case when c0 <> '' or ds = '' then s0 when c1 <> '' then s1 else trim(regexp_replace(ds, '[-_.]+', ' ', 'g')) end as cs, case when c0 <> '' or ds = '' then c0 when c1 <> '' then c1 else regexp_replace(ds, '[^a-z0-9]', '', 'g') end as cc,
 list_filter(tk, lambda t: length(t) >= 3 and t not in {STOP}) as ct, flatten(list_transform(aw, lambda t: case when regexp_matches(t, '^[0-9]+$') then case when ltrim(t, '0') not in ('', t) then [t, ltrim(t, '0')] else [t] end else list_filter(regexp_extract_all(t, '[0-9]+'), lambda d: length(d) >= 2) end)) as nums0,
 list_filter(aw, lambda t: length(t) >= 4 and not regexp_matches(t, '^[0-9]+$') and t not in ({texts(C.ADDRESS_STOPWORDS)})) as words from w0""",
    ),
    ("w2", "select *, list_filter(nums0, lambda x, i: list_position(nums0, x) = i) as nums, case when len(words) <= 4 then words else words[1:2] || words[-2:] end as ch0 from w1"),
    ("w3", "select *, list_filter(nums, lambda t: length(t) in (5, 6)) as zips, list_filter(ch0, lambda x, i: len(words) <= 4 or list_position(ch0, x) = i) as chosen from w2"),
]
_V2 = [
    _when("length(rc) >= 4 and rc <> nc", "'a_compact:' || rc"),
    _when("length(nn) >= 4", "'a_exact:' || nn"),
    _when("length(nc) >= 4", "'a_compact:' || nc"),
    _when("length(ns) >= 4", "'a_exact:' || ns", "'a_compact:' || replace(ns, ' ', '')"),
    _when("length(cc) >= 3", "'a_compact:' || cc", "'a_domain:' || cc"),
    _when("length(cs) >= 3 and cs <> cc", "'a_exact:' || cs"),
    _when("len(tk) >= 2", "'b_lead_bi:' || tk[1] || '_' || tk[2]"),
    _when("len(tk) >= 2 and length(tk[1]) + length(tk[2]) >= 5", "'a_compact:' || tk[1] || tk[2]"),
    "list_transform(ct[1:4], lambda t: 'b_tok:' || t)",
    _when("len(ct) >= 2", "'b_bi:' || ct[1] || '_' || ct[2]"),
    _when("len(ct) >= 3", "'b_bi:' || ct[1] || '_' || ct[3]"),
    _pairs("c_num_w", "nums[1:3]", "chosen[1:4]"),
    _pairs("c_zip_w", "zips[1:2]", "chosen[1:3]"),
    "list_transform(range(1, least(4, len(words))), lambda i: 'c_addr_bi:' || words[i] || '_' || words[i + 1])",
    _when("len(nums) > 0 and len(ct) > 0", "'d_name_num:' || ct[1] || '_' || nums[1]"),
    _when("len(nums) > 0 and length(nc) >= 5", "'d_pfx_num:' || nc[1:5] || '_' || nums[1]"),
    "case when len(ct) > 0 then list_transform(zips[1:2], lambda z: 'd_zip_name:' || z || '_' || ct[1]) else [] end",
]
KEYS_V2.append(
    (
        "keys",
        f"""select entity_id, source, upper(key[1:1]) as tag, key, pos from (select entity_id, source, unnest(ks) as key, unnest(range(len(ks))) as pos from (select entity_id, source, {" || ".join(_V2)} as ks from w3))
 union all select entity_id, source, 'B', 'b_rare:' || token, pos from (select entity_id, source, unnest(ct) as token, unnest(range(1000, 1000 + len(ct))) as pos from w3) join vocab using (token) where n > 1 and n <= 25""",
    )
)


def _steps(n: str, table) -> str:
    return "case " + " ".join(f"when {n} <= {most} then {value}" for most, value in table[:-1]) + f" else {table[-1][1]} end"


def candidates_v2(disk: bool = False) -> list[tuple[str, str]]:
    local = _steps("len_", C.LOCAL_DISCOUNTS)
    if disk:
        kept = [("kp", "select entity_id, key, n as len_ from keys join (select key, count(*) as n from keys where source <> 'S1' group by key having count(*) < 150) using (key) where source <> 'S1'")]
        discount = local
    else:
        kept = [("kp", "select entity_id, key, least(n, 150) as len_ from (select *, row_number() over (partition by key order by source, entity_id, pos) as r, count(*) over (partition by key) as n from keys where source <> 'S1') where r <= 150")]
        rest, counts = "string_split(key[strpos(key, ':') + 1:], '_')", lambda i: f"coalesce((select n from vocab where token = {{}}[{i}]), len_)"
        first = f"coalesce((select n from vocab where token = key[7:]), len_)"
        two = [counts(i).format(rest) for i in (1, 2)]
        discount = f"case when starts_with(key, 'b_tok:') then {_steps(first, C.DISCOUNTS['b_tok'][1])} when starts_with(key, 'b_bi:') or starts_with(key, 'b_lead_bi:') then {_steps(f'least({two[0]}, {two[1]})', C.DISCOUNTS['b_bi'][1])} when starts_with(key, 'c_addr_bi:') then {_steps(f'greatest({two[0]}, {two[1]})', C.DISCOUNTS['c_addr_bi'][1])} else 1.0 end"
    return [
        *kept,
        ("kd", f"select key, len_, cast({discount} as double) as d from (select distinct key, len_ from kp)"),
        ("scored", "select q.entity_id as s1_id, p.entity_id as candidate_id, sum(case q.tag when 'A' then 4 when 'D' then 3 else 2 end * d) as score from keys q join kp p using (key) join kd using (key, len_) where q.source = 'S1' group by all"),
        ("cand", "select * from (select s1_id, candidate_id, score, cast(row_number() over (partition by s1_id order by round(score, 6) desc, candidate_id) as integer) as rnk from scored) where rnk <= 120"),
    ]


def _set_share(a: str, b: str) -> str:
    union = f"len(list_distinct({a} || {b}))"
    return f"case when {union} = 0 then 1.0 else len(list_intersect({a}, {b})) / {union} end"


def _edit(a: str, b: str, quick: bool = False) -> str:
    early = f" when abs(length({a}) - length({b})) >= 0.8 * greatest(length({a}), length({b})) then 1.0 - abs(length({a}) - length({b})) / greatest(length({a}), length({b}))" if quick else ""
    return f"case when {a} = {b} then 1.0 when {a} = '' or {b} = '' then 0.0{early} else 1.0 - levenshtein({a}, {b}) / greatest(length({a}), length({b})) end"


def _grams(x: str) -> str:
    return f"case when {x} = '' then [] else list_distinct(list_transform(range(1, greatest(length({x}) - 2, 1) + 1), lambda i: {x}[i:i + 2])) end"


def _gram_share(a: str, b: str) -> str:
    return f"case when {a} = {b} then 1.0 when {a} = '' or {b} = '' then 0.0 else {_set_share(_grams(a), _grams(b))} end"


SIDES = "name_norm name_compact name_no_suffix address_norm country_norm".split()
ENRICHED: list[tuple[str, str]] = [
    (
        "full_",
        "select c.s1_id, c.candidate_id, cast(t.s1_id is not null as integer) as label, " + ", ".join(f"coalesce({p}.{c}, '') as {p}_{c}" for p in "ab" for c in SIDES) + ", a.legal_suffix as a_suf, b.legal_suffix as b_suf, a.name_script as a_script, b.name_script as b_script, b.is_domain, coalesce(b.domain_stem, '') as ds,"
        " a.address_is_missing or b.address_is_missing as miss, b.source as src from cand c join pre a on a.entity_id = c.s1_id join pre b on b.entity_id = c.candidate_id left join truth t on t.s1_id = c.s1_id and t.candidate_id = c.candidate_id",
    ),
    ("lists", f"select *, {_tokens('a_name_norm')} as wa, {_tokens('b_name_norm')} as wb, {_tokens('a_address_norm')} as aa, {_tokens('b_address_norm')} as ba from full_"),
    ("nums_", "select *, list_filter(aa, lambda t: regexp_matches(t, '^[0-9]+$')) as an, list_filter(ba, lambda t: regexp_matches(t, '^[0-9]+$')) as bn from lists"),
]


def _flag(x: str) -> str:
    return f"case when {x} then 1.0 else 0.0 end"


def feature_sql(extended: bool = False) -> dict[str, str]:
    addressed = lambda x, other="0.0": f"case when miss then {other} else {x} end"
    number = f"case when len(an) = 0 or len(bn) = 0 then -1.0 else {_flag('list_has_any(an, bn)')} end"
    known = ["{0}_country_norm not in ('', 'nan'{1})".format(p, ", 'none', 'null'" if extended else "") for p in "ab"]
    stem = "case when not is_domain or ds = '' then 0.0 when list_contains(wa, ds) then 1.0 when contains(array_to_string(wa, ''), ds) or contains(ds, array_to_string(wa, '')) then 0.75 else 0.0 end"
    out = {
        "name_exact_match": _flag("a_name_norm <> '' and a_name_norm = b_name_norm"),
        "name_compact_exact_match": _flag("a_name_compact <> '' and a_name_compact = b_name_compact"),
        "name_no_suffix_match": _flag("a_name_no_suffix <> '' and a_name_no_suffix = b_name_no_suffix"),
        "name_token_jaccard": _set_share("wa", "wb"),
        "name_token_overlap_count": "len(list_intersect(wa, wb))",
        "name_levenshtein_sim": _edit("a_name_norm", "b_name_norm", extended),
        "name_compact_levenshtein_sim": _edit("a_name_compact", "b_name_compact", extended),
        "legal_suffix_match": f"case when a_suf is not null and b_suf is not null then {_flag('a_suf = b_suf')} when a_suf is not null or b_suf is not null then 0.0 else -1.0 end",
        "domain_stem_match": stem,
        "script_match": _flag("a_script <> 'unknown' and a_script = b_script"),
        "address_exact_match": addressed(_flag("a_address_norm = b_address_norm")),
        "address_token_jaccard": addressed(_set_share("aa", "ba")),
        "address_token_overlap_count": addressed("len(list_intersect(aa, ba))"),
        "address_number_match": addressed(number, "-1.0"),
        "address_levenshtein_sim": addressed(_edit("a_address_norm", "b_address_norm", extended)),
        "address_missing_either": _flag("miss"),
        "country_exact_match": f"case when {known[0]} and {known[1]} then {_flag('lower(a_country_norm) = lower(b_country_norm)')} else -1.0 end",
        "country_missing_either": _flag(f"not ({known[0]} and {known[1]})"),
        "source_is_s2": _flag("src = 'S2'"),
        "name_len_diff_ratio": "abs(length(a_name_norm) - length(b_name_norm)) / greatest(length(a_name_norm), length(b_name_norm), 1)",
        "address_len_diff_ratio": "abs(length(a_address_norm) - length(b_address_norm)) / greatest(length(a_address_norm), length(b_address_norm), 1)",
    }
    if extended:
        short = {p: f"array_to_string(list_transform(w{p}, lambda t: t[1:1]), '')" for p in "ab"}
        a, b = short["a"], short["b"]
        weight = lambda x: f"list_sum(list_transform({x}, lambda t: coalesce(ws[t], dflt)))"
        union, inter = "list_sort(list_distinct(wa || wb))", "list_sort(list_intersect(list_distinct(wa), list_distinct(wb)))"
        own, of_stem = core_domain("b_name_norm")["compact"], core_domain("ds")["compact"]
        core = f"case when {own} <> '' then {own} when {of_stem} <> '' then {of_stem} else regexp_replace(ds, '[^a-z0-9]', '', 'g') end"
        zips = [f"list_filter({p}n, lambda t: length(t) in (5, 6))" for p in "ab"]
        out |= {
            "name_token_count_diff": "abs(len(wa) - len(wb))",
            "name_token_containment": _flag("len(wa) > 0 and len(wb) > 0 and (list_has_all(wa, wb) or list_has_all(wb, wa))"),
            "name_idf_jaccard": f"case when len({union}) = 0 then 1.0 when len(wa) = 0 or len(wb) = 0 then 0.0 else coalesce({weight(inter)}, 0.0) / {weight(union)} end",
            "name_char_3gram_jaccard": _gram_share("a_name_compact", "b_name_compact"),
            "name_acronym_match": _flag(f"(length({a}) >= 2 and {a} in (b_name_compact, b_name_norm)) or (length({b}) >= 2 and {b} in (a_name_compact, a_name_norm)) or (length({a}) >= 2 and {a} = {b})"),
            "address_number_conflict": addressed(_flag("len(an) > 0 and len(bn) > 0 and not list_has_any(an, bn)")),
            "address_postal_match": addressed(f"case when len({zips[0]}) = 0 or len({zips[1]}) = 0 then -1.0 else {_flag(f'list_has_any({zips[0]}, {zips[1]})')} end", "-1.0"),
            "address_char_3gram_jaccard": addressed(_gram_share("a_address_norm", "b_address_norm")),
            "domain_core_exact_match": f"(select {_flag('''c <> '' and (contains(a_name_compact, c) or contains(c, a_name_compact))''')} from (select {core} as c))",
            "domain_core_jaccard": f"(select case when c = '' then 0.0 else {_gram_share('a_name_compact', 'c')} end from (select {core} as c))",
            "country_one_sided_missing": _flag(f"({known[0]}) <> ({known[1]})"),
            "source_is_s3": _flag("src = 'S3'"),
            "source_s3_domain_stem_interaction": f"{_flag('''src = 'S3' ''')} * ({stem})",
        }
    return out


IDF: list[tuple[str, str]] = [
    ("idf", "select token, count(*) as df, ln(1 + ((select count(*) from pre) + 1) / (count(*) + 1)) as idf from (select unnest(list_distinct(string_split(name_norm, ' '))) as token from pre) where length(token) >= 2 group by token"),
]
RULE: list[tuple[str, str]] = [("rule", "select s1_id, candidate_id, label, round((nl + nj + aj) / 3, 4) as p from (select s1_id, candidate_id, label, {name_levenshtein_sim} as nl, {name_token_jaccard} as nj, {address_token_jaccard} as aj from nums_)".format(**feature_sql()))]
F05 = "case when nt = 0 and np = 0 then 1.0 when nt = 0 or np = 0 or nh = 0 then 0.0 else 1.25 * (nh / np) * (nh / nt) / (0.25 * (nh / np) + nh / nt) end"
PRECISION = "case when nt = 0 and np = 0 then 1.0 when nt = 0 or np = 0 then 0.0 else nh / np end"
RECALL = "case when nt = 0 and np = 0 then 1.0 when nt = 0 or np = 0 then 0.0 else nh / nt end"


def counts_at(threshold: str) -> str:
    """nt, np, nh by entity, of pairs of rule wa a threshold."""
    return f"select g.s1_id, len(g.ids) as nt, coalesce(x.np, 0) as np, coalesce(x.nh, 0) as nh from gt1 g left join (select s1_id, count(*) as np, sum(label) as nh from rule where cast(p as float) >= cast({threshold} as float) group by s1_id) x using (s1_id)"


def build(parts: list[tuple[str, str]], final: str) -> str:
    return "with " + ",\n".join(f"{name} as ({body})" for name, body in parts) + "\n" + final


V1 = [*BASE, *keys_v1(), *CANDIDATES_V1]
SCORED = [*V1, *ENRICHED, *RULE]
T = 0.55
SWEEP = "select cast(t as double) as threshold, round(avg(f), 9) as macro_f05, round(avg(pr), 9) as mean_precision, round(avg(re), 9) as mean_recall from (select t, {F05} as f, {PRECISION} as pr, {RECALL} as re from (select t.t, g.s1_id, len(g.ids) as nt, count(r.s1_id) as np, coalesce(sum(r.label), 0) as nh from gt1 g cross join (select unnest([{ts}]) as t) t left join rule r on r.s1_id = g.s1_id and cast(r.p as float) >= cast(t.t as float) group by all)) group by t".format(
    F05=F05, PRECISION=PRECISION, RECALL=RECALL, ts=", ".join(map(str, THRESHOLDS))
)
RECALL_OF = "select coalesce(avg(cast(c.s1_id is not null as integer)), 1.0) from truth t left join cand c on c.s1_id = t.s1_id and c.candidate_id = t.candidate_id"


WEIGHTS = ("weights_", "select map_from_entries(list(struct_pack(k := token, v := idf))) as ws, ln(1 + (select count(*) from pre) + 1) as dflt from idf")


def _extended(*names: str) -> str:
    found = feature_sql(True)
    return ", ".join(f"round(cast(cast({found[n]} as float) as double), 5) as {n}" for n in names)


def sql() -> dict[str, str]:
    script = {name: f"length(regexp_replace(letters, '[^{''.join(chr(int(a, 16)) + '-' + chr(int(b, 16)) for a, b in ranges)}]', '', 'g'))" for name, ranges in C.SCRIPTS}
    url = core_domain("url")
    out = {
        "null_literal_flags": build(BASE, "select entity_id, cast(u is null as integer) as name_missing, cast(a is null as integer) as address_missing from p0"),
        "clean_name_tokens": build(BASE, "select entity_id, name_norm, len(string_split(name_norm, ' ')) as n_tokens from pre"),
        "compact_name": build(BASE, "select entity_id, name_compact from pre"),
        "legal_suffix_extract": build(BASE, "select entity_id, legal_suffix, cast(has_legal_suffix as integer) as has_legal_suffix, name_no_suffix from pre"),
        "country_normalise": build(BASE, "select entity_id, country_norm from pre"),
        "address_normalise": build(BASE, "select entity_id, address_norm, cast(address_is_missing as integer) as address_is_missing from pre"),
        "address_order_independent": build(BASE, "select entity_id, address_order_indep from pre"),
        "domain_parse": build(BASE, "select entity_id, cast(is_domain as integer) as is_domain, domain_stem from pre"),
        "core_domain": f"select page_id, {url['stem']} as core_stem, {url['compact']} as core_compact from pages",
        "script_profile": f"select doc_id, {', '.join(f'{x} as n_{n}' for n, x in script.items())}, length(letters) as n_letters from (select doc_id, regexp_replace(text, '[^\\p{{L}}\\p{{M}}]', '', 'g') as letters from documents)",
        "blocking_keys_v1": build([*BASE, *keys_v1()], "select entity_id, tag, key, count(*) as n from keys group by all"),
        "blocking_keys_v2": build([*BASE, *KEYS_V2], "select entity_id, tag, key, count(*) as n from keys group by all"),
        "key_histogram": build([*BASE, *keys_v1()], "select n, count(*) as n_keys from (select key, count(*) as n from keys where source <> 'S1' group by key) group by n"),
        "hot_keys": build([*BASE, *keys_v1()], "select key, count(*) as n from keys where source <> 'S1' group by key having count(*) >= 100"),
        "candidates_v1": build(V1, "select * from cand"),
        "candidates_v2": build([*BASE, *KEYS_V2, *candidates_v2()], "select s1_id, candidate_id, round(score, 6) as score, rnk from cand"),
        "candidates_v2_disk": build([*BASE, *KEYS_V2, *candidates_v2(True)], "select s1_id, candidate_id, round(score, 6) as score, rnk from cand"),
        "candidate_recall": build(V1, f"select round(({RECALL_OF}), 9) as recall"),
        "reduction_ratio": build(V1, "select round(1.0 - (select count(*) from cand) / ((select count(*) from s1) * ((select count(*) from s2) + (select count(*) from s3))), 9) as reduction_ratio"),
        "recall_at_k": build(V1, f"select k, round(avg(case when c.rnk <= k then 1.0 else 0.0 end), 9) as recall from truth t left join cand c on c.s1_id = t.s1_id and c.candidate_id = t.candidate_id cross join (select unnest([{', '.join(map(str, KS))}]) as k) group by k"),
        "blocker_ablation": " union all ".join("(" + build([*BASE, *keys_v1(f), *CANDIDATES_V1], f"select '{f}' as families, (select count(*) from cand) as n_candidates, round(({RECALL_OF}), 9) as recall") + ")" for f in ("A", "AB", "ABC", "ABCD")),
        "blocking_diagnostics": build(
            [*V1, ("each_", "select g.s1_id, len(g.ids) as nt, coalesce(n, 0) as n from gt1 g left join (select s1_id, count(*) as n from cand group by s1_id) using (s1_id)"), ("hit_", "select t.candidate_id, cast(c.s1_id is not null as integer) as h from truth t left join cand c on c.s1_id = t.s1_id and c.candidate_id = t.candidate_id")],
            """select (select count(*) from each_) as total_s1_entities, (select count(*) from hit_) as total_true_matches, cast((select sum(h) from hit_) as bigint) as retrieved_true_matches, round((select avg(h) from hit_), 9) as overall_candidate_recall,
 round((select avg(h) from hit_ where starts_with(candidate_id, 'S2')), 9) as s2_candidate_recall, round((select avg(h) from hit_ where not starts_with(candidate_id, 'S2')), 9) as s3_candidate_recall, (select count(*) from each_ where nt = 0) as singleton_count, (select count(*) from each_ where nt = 0 and n = 0) as singleton_clean_count,
 (select count(*) from cand) as total_candidates, round(1.0 - (select count(*) from cand) / ((select count(*) from s1) * ((select count(*) from s2) + (select count(*) from s3))), 9) as candidate_reduction_ratio, round(avg(n), 9) as candidates_per_s1_mean, quantile_cont(n, 0.5) as candidates_per_s1_median,
 round(quantile_cont(n, 0.9), 9) as candidates_per_s1_p90, round(quantile_cont(n, 0.95), 9) as candidates_per_s1_p95, round(quantile_cont(n, 0.99), 9) as candidates_per_s1_p99, max(n) as candidates_per_s1_max, min(n) as candidates_per_s1_min from each_""",
        ),
        "token_vocabulary": build([*BASE, KEYS_V2[0]], "select token, n from vocab"),
        "rare_tokens": build([*BASE, KEYS_V2[0]], "select token, n from vocab where n > 1 and n <= 25"),
        "token_idf": build([*BASE, *IDF], "select token, df, round(idf, 9) as idf from idf"),
        "expand_ground_truth": build(BASE, "select g.s1_id, t.candidate_id from gt1 g left join truth t using (s1_id)"),
        "match_cardinality": build(BASE, "select len(ids) as n_matches, count(*) as n_entities, count(*) filter (array_to_string(ids, ' ') like '%S2%') as n_s2, count(*) filter (array_to_string(ids, ' ') like '%S3%') as n_s3, count(*) filter (array_to_string(ids, ' ') like '%S2%' and array_to_string(ids, ' ') like '%S3%') as n_both from gt1 group by all"),
        "source_profile": build(BASE, f"select source, count(*) as n_rows, count(distinct entity_id) as n_ids, count(*) filter ({MISSING.format('business_name')}) as n_missing_name, count(*) filter ({MISSING.format('business_address')}) as n_missing_address, count(*) filter ({MISSING.format('country')}) as n_missing_country, cast(min(length(business_name)) as integer) as min_length, quantile_cont(length(business_name), 0.5) as median_length, round(avg(length(business_name)), 9) as mean_length, cast(max(length(business_name)) as integer) as max_length, count(*) filter (length(business_name) <= 3) as n_short from raw group by source"),
        "country_counts": build(BASE, "select source, country_norm, count(*) as n from pre group by all"),
        "labelled_pairs": build([*V1, *ENRICHED], "select s1_id, candidate_id, label, src as cand_source, a_name_norm as s1_name_norm, b_name_norm as cand_name_norm from full_"),
        "negative_sample": build(
            [*V1, *ENRICHED, ("num_", "select s1_id, candidate_id, label, (cast(s1_id[4:] as bigint) * 7919 + cast(candidate_id[4:] as bigint) * 104729) % 65537 as h, sum(label) over (partition by s1_id) as np from full_"), ("rank_", "select *, row_number() over (partition by s1_id, label order by h, candidate_id) as r from num_")],
            "select s1_id, candidate_id, label from rank_ where label = 1 or r <= case when np > 0 then greatest(1, np * 2) else 2 end",
        ),
        "features_21": build([*V1, *ENRICHED], "select s1_id, candidate_id, label, " + ", ".join(f"round(cast({x} as double), 9) as {n}" for n, x in feature_sql().items()) + " from nums_"),
        "features_34": build(
            [*V1, *ENRICHED, *IDF, ("weights_", "select map_from_entries(list(struct_pack(k := token, v := idf))) as ws, ln(1 + (select count(*) from pre) + 1) as dflt from idf")],
            "select s1_id, candidate_id, label, " + ", ".join(f"round(cast(cast({x} as float) as double), 5) as {n}" for n, x in feature_sql(True).items()) + " from nums_ cross join weights_",
        ),
        "rule_score_predict": build(SCORED, f"select s1_id, candidate_id from rule where cast(p as float) >= cast({T} as float)"),
        "entity_f05": build([*SCORED, ("c_", counts_at(str(T)))], f"select s1_id, round({PRECISION}, 9) as precision, round({RECALL}, 9) as recall, round({F05}, 9) as f05 from c_"),
        "macro_f05": build([*SCORED, ("c_", counts_at(str(T)))], f"select round(avg({F05}), 9) as macro_f05 from c_"),
        "threshold_sweep": build(SCORED, SWEEP),
        "best_threshold": build([*SCORED, ("sweep_", SWEEP)], "select * from sweep_ order by macro_f05 desc, threshold limit 1"),
        "threshold_report": build(
            [*SCORED, ("c_", counts_at(str(T)))],
            f"select round(avg({F05}), 9) as macro_f05, round(avg({PRECISION}), 9) as mean_entity_precision, round(avg({RECALL}), 9) as mean_entity_recall, round(avg(cast(np = 0 as integer)) filter (nt = 0), 9) as singleton_accuracy, round(avg({F05}) filter (nt > 0), 9) as non_singleton_macro_f05, count(*) as num_entities, count(*) filter (nt = 0) as num_singletons, count(*) filter (nt > 0) as num_non_singletons, count(*) filter (np > nh) as num_fp_entities, count(*) filter (nt > nh) as num_fn_entities from c_",
        ),
        "pair_metrics": build(SCORED, f"select round(h / s, 9) as pair_precision, round(h / t, 9) as pair_recall, round(2 * h / (s + t), 9) as pair_f1 from (select count(*) filter (x and label = 1) as h, count(*) filter (x) as s, count(*) filter (label = 1) as t from (select label, cast(p as float) >= cast({T} as float) as x from rule))"),
        "average_precision": build([*SCORED, ("s_", "select p, count(*) as n, sum(label) as pos from rule group by p"), ("w_", "select pos, sum(n) over (order by p desc) as seen, sum(pos) over (order by p desc) as hits from s_")], "select round(sum(pos * hits / seen) / sum(pos), 9) as average_precision from w_"),
        "roc_auc": build([*SCORED, ("r_", "select label, rank() over (order by p) + (count(*) over (partition by p) - 1) / 2 as r from rule")], "select round((sum(r) filter (label = 1) - count(*) filter (label = 1) * (count(*) filter (label = 1) + 1) / 2) / (cast(count(*) filter (label = 1) as double) * count(*) filter (label = 0)), 9) as roc_auc from r_"),
        "error_analysis": build(
            [*SCORED, ("said", f"select s1_id, candidate_id from rule where cast(p as float) >= cast({T} as float)"), ("every", "select coalesce(t.s1_id, s.s1_id) as s1_id, coalesce(t.candidate_id, s.candidate_id) as candidate_id, t.s1_id is not null as t, s.s1_id is not null as p from truth t full join said s on t.s1_id = s.s1_id and t.candidate_id = s.candidate_id"), ("e_", "select e.*, c.s1_id is not null as c, len(g.ids) = 0 as single from every e left join cand c on c.s1_id = e.s1_id and c.candidate_id = e.candidate_id join gt1 g on g.s1_id = e.s1_id")],
            """select *, singleton_total - singleton_false_positives as singleton_correct, round(100.0 * blocking_misses / total_true_matches, 9) as blocking_miss_rate_pct, round(100.0 * classifier_misses / total_true_matches, 9) as classifier_miss_rate_pct from (select count(*) filter (t) as total_true_matches, count(*) filter (t and p) as true_positives, count(*) filter (not t and p) as false_positives, count(*) filter (t and not p) as total_false_negatives, count(*) filter (t and not p and not c) as blocking_misses, count(*) filter (t and not p and c) as classifier_misses,
 count(*) filter (t and not p and not c and starts_with(candidate_id, 'S2')) as s2_blocking_misses, count(*) filter (t and not p and not c and starts_with(candidate_id, 'S3')) as s3_blocking_misses, count(*) filter (t and not p and c and starts_with(candidate_id, 'S2')) as s2_classifier_misses, count(*) filter (t and not p and c and starts_with(candidate_id, 'S3')) as s3_classifier_misses,
 count(distinct case when single and p then s1_id end) as singleton_false_positives, (select count(*) from gt1) as total_entities, (select count(*) from gt1 where len(ids) = 0) as singleton_total from e_)""",
        ),
        "margin_filter": build(SCORED, f"select s1_id, candidate_id, p from (select *, max(p) over (partition by s1_id) as top from rule where cast(p as float) >= cast({T} as float)) where p >= top - 0.1"),
        "matching_results": build([*SCORED, ("said", f"select s1_id, candidate_id from rule where cast(p as float) >= cast({T} as float)")], "select s1.entity_id as source1_entity_id, coalesce(string_agg(candidate_id, ',' order by candidate_id), '') as matched_entity_ids from s1 left join said on said.s1_id = s1.entity_id group by s1.entity_id"),
        "candidate_pairs": build(V1, "select s1.entity_id as source1_entity_id, coalesce(string_agg(candidate_id, ',' order by candidate_id), '') as candidate_entity_ids from s1 left join cand on cand.s1_id = s1.entity_id group by s1.entity_id"),
        "distractor_sample": build(
            [*BASE, ("chosen", "select source1_entity_id as s1_id from gt order by 1 limit 100"), ("need", "select distinct candidate_id as entity_id from truth where s1_id in (select s1_id from chosen)")],
            "select entity_id from s1 where entity_id in (select s1_id from chosen) union all select entity_id from need union all (select entity_id from s2 where entity_id not in (select entity_id from need) order by 1 limit 25) union all (select entity_id from s3 where entity_id not in (select entity_id from need) order by 1 limit 25)",
        ),
        "miss_causes": build([*V1, ("missed", "select t.* from truth t left join cand c on c.s1_id = t.s1_id and c.candidate_id = t.candidate_id where c.s1_id is null"), ("both_", "select distinct m.s1_id, m.candidate_id, a.key from missed m join keys a on a.entity_id = m.s1_id join keys b on b.entity_id = m.candidate_id and b.key = a.key")], "select m.s1_id, m.candidate_id, coalesce(string_agg(key, ' ' order by key), '') as shared from missed m left join both_ using (s1_id, candidate_id) group by all"),
        "name_similarity": build([*V1, *ENRICHED], "select s1_id, candidate_id, " + ", ".join(f"round(cast({feature_sql()[n]} as double), 9) as {n}" for n in ("name_token_jaccard", "name_levenshtein_sim", "name_compact_levenshtein_sim")) + " from nums_"),
        "trigram_jaccard": build([*V1, *ENRICHED], f"select s1_id, candidate_id, {_extended('name_char_3gram_jaccard', 'address_char_3gram_jaccard', 'domain_core_jaccard')} from nums_"),
        "idf_jaccard": build([*V1, *ENRICHED, *IDF, WEIGHTS], f"select s1_id, candidate_id, {_extended('name_idf_jaccard')} from nums_ cross join weights_"),
        "extended_inference": build(
            [*V1, *ENRICHED, *IDF, WEIGHTS, ("f_", f"select s1_id, candidate_id, {_extended('name_idf_jaccard', 'name_char_3gram_jaccard', 'address_char_3gram_jaccard')} from nums_ cross join weights_"), ("said", f"select s1_id, candidate_id from f_ where cast(round((name_idf_jaccard + name_char_3gram_jaccard + address_char_3gram_jaccard) / 3, 4) as float) >= cast({T} as float)")],
            "select s1.entity_id as source1_entity_id, coalesce(string_agg(candidate_id, ',' order by candidate_id), '') as matched_entity_ids from s1 left join said on said.s1_id = s1.entity_id group by s1.entity_id",
        ),
        "displacement": build([*BASE, *keys_v1(), *CANDIDATES_V1[:2], ("place_", "select s1_id, candidate_id, cast(row_number() over (partition by s1_id order by score desc, candidate_id) as integer) as rnk from scored"), ("r_", "select rnk from truth join place_ using (s1_id, candidate_id)")], "select count(*) as n_found, quantile_cont(rnk, 0.5) as median_rank, round(quantile_cont(rnk, 0.99), 9) as p99_rank, max(rnk) as max_rank, count(*) filter (rnk > 5) as n_displaced from r_"),
        "split_entities": build(BASE, "select s1_id, case when row_number() over (order by (cast(s1_id[4:] as bigint) * 7919) % 65537, s1_id) <= greatest(1, floor(count(*) over () * 0.2)) then 'val' else 'train' end as split from gt1"),
        "detect_script": f"""with l as (select doc_id, text, regexp_replace(text, '[^\\p{{L}}\\p{{M}}]', '', 'g') as letters from documents),
 n as (select doc_id, text, length(letters) as total, {', '.join(f'{x} as n_{n}' for n, x in script.items())} from l),
 o as (select *, [n_latin, n_devanagari, n_tamil, n_kannada, n_gujarati, n_other_indic, total - n_latin - n_devanagari - n_tamil - n_kannada - n_gujarati - n_other_indic] as c from n),
 d as (select *, list_max(c) as most, list_position(c, list_max(c)) as place from o)
 select doc_id, case when {MISSING.format('text')} or total = 0 then 'unknown' when most < 0.7 * total or len(list_filter(c, lambda x, i: i <> place and x >= 2 and (x >= 0.05 * total or x >= 3))) > 0 then 'mixed' else ['latin', 'devanagari', 'tamil', 'kannada', 'gujarati', 'other_indic', 'other'][place] end as script from d""",
        # written by hand
        "odd_records": """select * from (values
 ('O-01', 'tamsin s bicycle repair llc', 'llc', 'tamsin s bicycle repair', null, 'latin', '12 elm street apartment 4', '12 4 apartment elm street', 'US'),
 ('O-02', 'pvt qrt lantern works ltd', 'pvt_ltd', 'qrt lantern works', null, 'latin', 'pobox 7', '7 pobox', 'US'),
 ('O-03', 'llc quillback pottery studio', 'llc', 'quillback pottery studio', null, 'latin', null, null, 'India'),
 ('O-04', 'driftmoor bay inc carpets', 'inc', 'driftmoor bay carpets', null, 'latin', null, null, 'Brazil'),
 ('O-05', 'राम प्राइवेट लिमिटेड', 'pvt_ltd', 'राम', null, 'devanagari', null, null, 'JPN'),
 ('O-06', 'acme ltd', 'ltd', 'acme', null, 'latin', null, null, ''),
 ('O-07', 'https www quiet harbour com about', null, 'https www quiet harbour com about', 'quiet-harbour', 'latin', '4 apartment elm street 12', '12 4 apartment elm street', ''),
 ('O-08', 'velmora tiles www velmoratl com', null, 'velmora tiles', 'velmoratl', 'latin', '9 rue de l église', '9 de l rue église', 'New Zealand'),
 ('O-09', 'acme हिन्दी', null, 'acme हिन्दी', null, 'mixed', 'ünter weg 5', '5 weg ünter', 'France'),
 ('O-10', null, null, null, null, 'unknown', '१२ मार्ग', 'मार्ग १२', 'United Kingdom'),
 ('O-11', 'müller and söhne co', 'co', 'müller and söhne', null, 'latin', '5 oak road', '5 oak road', 'Germany'),
 ('O-12', '123 45', null, '123 45', null, 'unknown', '5 6', '5 6', 'Canada'))
 t(entity_id, name_norm, legal_suffix, name_no_suffix, domain_stem, name_script, address_norm, address_order_indep, country_norm)""",
    }
    return out
