"""What the named queries must return, as SQL for DuckDB. Vocabularies and rules stand here by themselves: nothing is taken from the modules under test."""

from __future__ import annotations

from tessera.plans import fixture

REC = fixture.SQL
ALIASES = "alias(kind, country, variant, canonical, cnt) AS (VALUES " + ", ".join(f"('{k}', '{c}', '{v}', '{n}', {x}::BIGINT)" for k, c, v, n, x in fixture.ALIASES) + ")"


def low(x: str) -> str:
    """Lower case without the accents that the records have."""
    return f"translate(lower({x}), 'áàâäéèêëíìîïóòôöúùûüñç', 'aaaaeeeeiiiioooouuuunc')"


def norm(x: str) -> str:
    return rf"trim(regexp_replace({low(x)}, '[\p{{P}}\p{{S}}\p{{Z}}\p{{C}}]+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), x -> x <> '')"


def jaccard(a: str, b: str, empty: str = "0.0") -> str:
    both = f"list_distinct(list_concat({a}, {b}))"
    return f"CASE WHEN len({both}) = 0 THEN {empty} ELSE len(list_intersect({a}, {b})) / len({both}) END"


GENERAL = "'inc': 'inc', 'incorporated': 'inc', 'corp': 'corp', 'corporation': 'corp', 'llc': 'llc', 'llp': 'llp', 'lp': 'lp', 'pllc': 'pllc', 'pc': 'pc', 'plc': 'plc', 'co': 'co', 'company': 'co', 'ltd': 'ltd', 'limited': 'ltd'"
INDIA = "'pvt': 'pvt', 'private': 'pvt', 'प्राइवेट': 'pvt', 'लिमिटेड': 'ltd'"
FRANCE = "'sarl': 'sarl', 'sas': 'sas', 'sasu': 'sasu', 'eurl': 'eurl', 'sa': 'sa', 'sci': 'sci', 'snc': 'snc', 'ei': 'ei'"
LEGAL = f"CASE country WHEN 'India' THEN MAP {{{GENERAL}, {INDIA}}} WHEN 'France' THEN MAP {{{GENERAL}, {FRANCE}}} ELSE MAP {{{GENERAL}}} END"
PLACES = "'st': 'street', 'str': 'street', 'rd': 'road', 'ave': 'avenue', 'av': 'avenue', 'blvd': 'boulevard', 'dr': 'drive', 'ln': 'lane', 'ct': 'court', 'hwy': 'highway', 'pkwy': 'parkway', 'ste': 'suite', 'apt': 'apartment', 'no': 'number'"
ADDRESS = f"CASE country WHEN 'India' THEN MAP {{{PLACES}, 'pl': 'place', 'nr': 'near', 'opp': 'opposite', 'soc': 'society', 'flr': 'floor', 'h': 'house'}} WHEN 'France' THEN MAP {{{PLACES}, 'pl': 'place', 'r': 'rue', 'n': 'number', 'bd': 'boulevard', 'all': 'allee', 'imp': 'impasse', 'rte': 'route', 'chem': 'chemin', 'fg': 'faubourg'}} ELSE MAP {{{PLACES}, 'pl': 'place'}} END"
DOMAIN = r"(?i)\b[a-z0-9][a-z0-9-]*\.(com|net|org|io|biz|info|in|co)\b"
NAMED = f"regexp_matches(business_name, '{DOMAIN}')"
IS = "len(map_extract(lv, x)) > 0"

PARTS = (
    REC
    + f""", n0 AS (SELECT *, {LEGAL} AS lv, {ADDRESS} AS av, {norm('business_name')} AS name_norm, {NAMED} AS is_domain, lower(trim(country)) AS country_norm FROM rec),
n1 AS (SELECT *, {words('name_norm')} AS toks FROM n0),
n2 AS (SELECT *, list_filter(toks, x -> NOT ({IS}) AND NOT (is_domain AND x IN ('www', 'com', 'net', 'org', 'io', 'biz', 'info', 'co', 'in', 'uk'))) AS name_tokens,
  list_sort(list_distinct(list_transform(list_filter(toks, x -> {IS}), x -> map_extract(lv, x)[1]))) AS forms,
  list_transform(list_filter(list_transform(string_split(business_address, ','), p -> {norm('p')}), p -> p NOT IN ('', 'null', 'na', 'n a', 'none', 'nan')),
    p -> array_to_string(list_transform(string_split(p, ' '), t -> coalesce(map_extract(av, t)[1], t)), ' ')) AS addr_components,
  array_to_string(list_transform({words(norm('business_address'))}, t -> coalesce(map_extract(av, t)[1], t)), ' ') AS addr_norm,
  list_distinct(list_transform(regexp_extract_all(business_address, '[0-9]+'), x -> regexp_replace(x, '^0+(.)', '\\1'))) AS addr_numbers FROM n1)"""
)


def _named(kind: str, at: int) -> str:
    raw = f"coalesce(n2.addr_components[{at}], '')"
    has = f"n2.country IN (SELECT country FROM alias WHERE kind = '{kind}')"
    own = f"(SELECT struct_pack(canonical, cnt) FROM alias a WHERE a.kind = '{kind}' AND a.country = n2.country AND a.variant = {raw})"
    generic = f"(SELECT struct_pack(canonical, cnt) FROM alias a WHERE a.kind = '{kind}' AND a.country = '_generic' AND a.variant = {raw})"
    return f"{raw} AS {kind}_raw, CASE WHEN {has} THEN {own} ELSE {generic} END AS {kind}_alias"


NORM = (
    PARTS
    + f""", {ALIASES}, n3 AS (SELECT *, {_named('state', -1)}, {_named('city', -2)} FROM n2),
norm AS (SELECT *, array_to_string(name_tokens, ' ') AS name_core, array_to_string(list_sort(name_tokens), ' ') AS name_sorted, array_to_string(name_tokens, '') AS name_compact,
  CASE WHEN list_contains(forms, 'pvt') AND list_contains(forms, 'ltd') THEN array_to_string(list_concat(['pvt_ltd'], list_filter(forms, x -> x NOT IN ('pvt', 'ltd'))), '_') ELSE array_to_string(forms, '_') END AS legal_form,
  coalesce(state_alias.canonical, state_raw) AS state_canon, coalesce(city_alias.canonical, city_raw) AS city_canon,
  CASE WHEN len(addr_components) >= 2 AND (length(city_raw) < 3 OR coalesce(city_alias.cnt, 20) < 20) THEN '' ELSE coalesce(city_alias.canonical, city_raw) END AS city_trusted FROM n3)"""
)
KEYS = NORM + """, keys AS (SELECT DISTINCT entity_id, pos, source, unnest(list_concat(list_transform(addr_numbers, x -> 'a|' || country_norm || '|' || x || '|' || state_canon),
  list_transform(list_filter(list_sort(list_distinct(name_tokens))[1:4], x -> length(x) >= 3), x -> 'n|' || country_norm || '|' || x))) AS key FROM norm WHERE country_norm <> '')"""
CAND = KEYS + """, allp AS (SELECT DISTINCT a.entity_id AS s1_id, a.pos AS s1_pos, b.entity_id AS target_id, b.source AS target_source, b.pos AS target_pos FROM keys a JOIN keys b ON a.key = b.key WHERE a.source = 'S1' AND b.source <> 'S1'),
cand AS (SELECT * FROM allp QUALIFY row_number() OVER (PARTITION BY s1_id, target_source ORDER BY target_pos, target_id) <= 30)"""
_SAME = "CAST(a.{0} = b.{0} AND a.{0} <> '' AS INT)"
FEAT = CAND + f""", feat AS (SELECT c.*, {_SAME.format('name_core')} AS name_core_exact, {_SAME.format('name_compact')} AS name_compact_exact, {_SAME.format('addr_norm')} AS address_exact,
  {jaccard('a.addr_components', 'b.addr_components')} AS address_component_jaccard, CAST(len(list_intersect(a.addr_numbers, b.addr_numbers)) AS INT) AS addr_number_overlap,
  {_SAME.format('state_canon')} AS state_match, {_SAME.format('city_trusted')} AS city_match, {_SAME.format('legal_form')} AS legal_form_match, CAST(a.country_norm = b.country_norm AS INT) AS country_match,
  CAST(abs(length(a.name_core) - length(b.name_core)) AS INT) AS name_len_diff, CAST(abs(length(a.addr_norm) - length(b.addr_norm)) AS INT) AS address_len_diff, {jaccard('a.name_tokens', 'b.name_tokens')} AS name_jaccard
  FROM cand c JOIN norm a ON a.entity_id = c.s1_id JOIN norm b ON b.entity_id = c.target_id),
scored AS (SELECT *, round(0.6 * name_jaccard + 0.2 * address_component_jaccard + 0.1 * state_match + 0.1 * name_core_exact, 6) AS probability FROM feat),
acc AS (SELECT * FROM scored WHERE NOT (name_jaccard < 0.35 AND address_component_jaccard < 0.20 AND state_match = 0)),
won AS (SELECT * FROM acc WHERE probability >= 0.7 QUALIFY row_number() OVER (PARTITION BY target_source, target_id ORDER BY probability DESC, s1_pos) = 1)"""


def macro(pred: str, by: str = "", single: str = "1.0") -> str:
    """Macro F0.5 of predicted pairs, by threshold where there is one."""
    also = f"{by}, " if by else ""
    every = f"(SELECT entity_id AS s1_id{', ' + by if by else ''} FROM rec{', th' if by else ''} WHERE source = 'S1')"
    on = f"e.s1_id = p.s1_id{f' AND e.{by} = p.{by}' if by else ''}"
    shown = f"round({by}, 4) AS {by}, " if by else ""
    return f""", pt AS (SELECT {also}s1_id, count(*) AS p, count(*) FILTER (WHERE (s1_id, target_id) IN (SELECT (s1_id, target_id) FROM truth)) AS tp FROM {pred} GROUP BY ALL), tt AS (SELECT s1_id, count(*) AS t FROM truth GROUP BY 1),
ev AS (SELECT e.*, coalesce(t, 0) AS t, coalesce(p, 0) AS p, coalesce(tp, 0) AS tp FROM {every} e LEFT JOIN tt USING (s1_id) LEFT JOIN pt p ON {on}),
pr AS (SELECT *, CASE WHEN p = 0 THEN 0.0 ELSE tp / p END AS pre, CASE WHEN t = 0 THEN 1.0 ELSE tp / t END AS re FROM ev),
f AS (SELECT {also}count(*) AS n, round(avg(CASE WHEN t = 0 AND p = 0 THEN {single} WHEN 0.25 * pre + re = 0 THEN 0.0 ELSE 1.25 * pre * re / (0.25 * pre + re) END), 6) AS macro_f05 FROM pr {'GROUP BY ' + by if by else ''})
SELECT {shown}n, macro_f05 FROM f"""


def thresholds() -> list[float]:
    out, t = [], 0.30
    while t <= 0.95 + 1e-9:
        out.append(t)
        t += 0.02
    return out


SWEEP = FEAT + f", th AS (SELECT unnest([{', '.join(f'{t!r}::DOUBLE' for t in thresholds())}]) AS threshold), sw AS (SELECT a.*, threshold FROM acc a JOIN th ON probability >= threshold QUALIFY row_number() OVER (PARTITION BY target_source, target_id, threshold ORDER BY probability DESC, s1_pos) = 1)"
WORD = NORM + ", tok AS (SELECT entity_id, source, unnest(list_distinct(name_tokens)) AS token FROM norm), rare AS (SELECT token FROM tok WHERE source <> 'S1' GROUP BY 1 HAVING count(*) < 0.01 * (SELECT count(*) FROM norm WHERE source <> 'S1')), rp AS (SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS target_id FROM tok a JOIN tok b ON a.token = b.token JOIN rare r ON r.token = a.token WHERE a.source = 'S1' AND b.source <> 'S1')"


def similar(name: str, rows: str, column: str, by: bool, k: int) -> str:
    """CTEs up to {name}_top (s1_id, target_id, similarity, rank): the k nearest by trigrams of a column, of all or of the query's country."""
    c, using, within = ("country, ", "USING (country, gram)", "PARTITION BY country") if by else ("", "USING (gram)", "")
    return f""", {name}_g AS (SELECT entity_id, source, {c}substr(t, i, 3) AS gram, count(*) AS tf FROM (SELECT entity_id, source, {c}{column} AS t, unnest(range(1, length({column}) - 1)) AS i FROM {rows}) GROUP BY ALL),
{name}_n AS (SELECT {c}count(*) AS n FROM {rows} WHERE source <> 'S1' GROUP BY ALL),
{name}_df AS (SELECT {c}gram, count(*) AS df FROM {name}_g WHERE source <> 'S1' GROUP BY ALL),
{name}_x AS (SELECT g.*, tf * (ln((1 + coalesce(n, 0)) / (1 + coalesce(df, 0))) + 1) AS x FROM {name}_g g LEFT JOIN {name}_df {using} LEFT JOIN {name}_n ON {'g.country = ' + name + '_n.country' if by else 'true'}),
{name}_w AS (SELECT entity_id, source, {c}gram, x / sqrt(sum(x * x) OVER (PARTITION BY entity_id)) AS w FROM {name}_x),
{name}_sim AS (SELECT a.entity_id AS s1_id, b.entity_id AS target_id, round(sum(a.w * b.w), 6) AS similarity FROM {name}_w a JOIN {name}_w b {using} WHERE a.source = 'S1' AND b.source <> 'S1' GROUP BY ALL),
{name}_top AS (SELECT *, CAST(row_number() OVER (PARTITION BY s1_id ORDER BY similarity DESC, target_id) AS INT) AS rank FROM {name}_sim QUALIFY rank <= {k})"""


US_ZIP = r"(?:\b[A-Za-z]{2}\s+|^\s*|,\s*)(\d{5})(?:-\d{4})?\s*(?:,|$)"
#: India's and France's patterns look around; what the records hold, a component of six or five digits, they find just so.
CODE = f"CASE country WHEN 'US' THEN nullif(regexp_extract(business_address, '{US_ZIP}', 1), '') WHEN 'India' THEN nullif(regexp_extract(business_address, '(?:^|,) *([1-9][0-9]{{5}}) *(?:,|$)', 1), '') WHEN 'France' THEN nullif(regexp_extract(business_address, '(?:^|,) *([0-9]{{5}}) *(?:,|$)', 1), '') END"
PROBE = NORM + f", pr0 AS (SELECT *, toks AS nt, name_norm AS name_text, name_norm || ' ' || {norm('business_address')} AS name_address, {CODE} AS code FROM norm)"
OUT = CAND + ", g AS (SELECT s1_id, string_agg(target_id, ',' ORDER BY target_id) AS ids FROM cand GROUP BY 1), l AS (SELECT s1_id, string_split(ids || ',S1-1,X-2,' || ids, ',') AS x FROM g)"
PAIRS = NORM + f""", side AS (SELECT *, {words(norm('business_address'))} AS places, {CODE} AS code FROM norm),
pm AS (SELECT t.target_source, b.country AS country, a.country AS a_country, a.business_name AS an, b.business_name AS bn, a.name_norm AS ann, b.name_norm AS bnn, a.code AS ac, b.code AS bc, t.s1_id, t.target_id,
  {jaccard('a.toks', 'b.toks', '1.0')} AS j, {jaccard('a.places', 'b.places', '1.0')} AS aj FROM truth t JOIN side a ON a.entity_id = t.s1_id JOIN side b ON b.entity_id = t.target_id)"""
BIN = "CASE WHEN {0} = 0 THEN '0' WHEN {0} < 0.25 THEN '(0,.25)' WHEN {0} < 0.5 THEN '[.25,.5)' WHEN {0} < 0.75 THEN '[.5,.75)' WHEN {0} < 1 THEN '[.75,1)' ELSE '1' END"


def mean(x: str) -> str:
    return f"round(avg({x}), 6)"


def share(x: str) -> str:
    return f"round(avg(CAST({x} AS INT)), 6)"


#: Of each country and source, the pool by hash; a record looks from its own place on for one that is no match.
HASHED = """, pool AS (SELECT source, country, entity_id AS target_id, row_number() OVER (PARTITION BY source, country ORDER BY md5(entity_id || '42'), entity_id) - 1 AS at FROM rec WHERE source <> 'S1'),
psize AS (SELECT source, country, count(*) AS size FROM pool GROUP BY ALL),
ask AS (SELECT r.entity_id AS s1_id, p.source, p.country, size, CAST('0x' || substr(md5(r.entity_id || p.source || '42'), 1, 8) AS BIGINT) AS first, unnest(range(0, least(8, size))) AS step FROM rec r JOIN psize p USING (country) WHERE r.source = 'S1'),
other AS (SELECT s1_id, p.target_id, a.source AS target_source FROM ask a JOIN pool p ON p.source = a.source AND p.country = a.country AND p.at = (a.first + a.step) % a.size
  WHERE NOT EXISTS (SELECT 1 FROM truth t WHERE t.s1_id = a.s1_id AND t.target_id = p.target_id) QUALIFY row_number() OVER (PARTITION BY s1_id, a.source ORDER BY step) = 1)"""
BEFORE_AFTER = PAIRS.split(", pm AS")[0] + HASHED + f""", bp AS (SELECT s1_id, target_id, target_source, 'pair' AS kind FROM truth UNION ALL SELECT s1_id, target_id, target_source, 'non-pair' FROM other),
plain AS (SELECT *, list_filter(list_transform(string_split(business_address, ','), p -> {norm('p')}), p -> p <> '') AS parts, regexp_extract_all(business_address, '[0-9]+') AS digits FROM norm),
ba AS (SELECT a.country, target_source, kind, 'BEFORE' AS variant, a.name_norm AS an, b.name_norm AS bn, a.toks AS aw, b.toks AS bw, a.parts AS ap, b.parts AS bp, a.digits AS ad, b.digits AS bd FROM bp JOIN plain a ON a.entity_id = s1_id JOIN plain b ON b.entity_id = target_id
 UNION ALL SELECT a.country, target_source, kind, 'AFTER', a.name_core, b.name_core, a.name_tokens, b.name_tokens, a.addr_components, b.addr_components, a.addr_numbers, b.addr_numbers FROM bp JOIN plain a ON a.entity_id = s1_id JOIN plain b ON b.entity_id = target_id)
SELECT country, target_source, kind, variant, count(*) AS n, {mean(jaccard('aw', 'bw', '1.0'))} AS name_jaccard, {share('(' + jaccard('aw', 'bw', '1.0') + ') = 0')} AS name_jaccard_0, {share("an = bn AND an <> ''")} AS name_equal,
 {mean(jaccard('ap', 'bp', '1.0'))} AS parts_jaccard, {share('len(list_intersect(ad, bd)) > 0')} AS number_shared FROM ba GROUP BY ALL"""
