"""DuckDB SQL for the linkage queries, built from shared common table expressions."""

from __future__ import annotations

from ..functions.text import ENDINGS, LEGAL_FORMS
from ..operators.blocking import PRIME, coefficients
from ..operators.features import FEATURES
from ..operators.keyed import COMMON_WORDS, INDIAN_STATES, US_STATES
from ..sources.directory import CTES

_MARK = r"(?i)\b(?:near(?:\s+to)?|opp(?:\.|\s+to|\s+site)?|opposite|behind|beside|adj(?:\.|\s+to)?|adjacent(?:\s+to)?|in\s+front\s+of)\b"


def norm(e: str) -> str:
    return f"trim(regexp_replace(replace(replace(lower(coalesce({e}, '')), '&', ' and '), '''', ''), '[^a-z0-9]+', ' ', 'g'))"


def words(e: str) -> str:
    return f"CASE WHEN {e} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({e}, ' ') END"


def jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len(list_distinct(list_concat({a}, {b}))) = 0 THEN 0.0 ELSE CAST(len(list_intersect(list_distinct({a}), list_distinct({b}))) AS DOUBLE) / len(list_distinct(list_concat({a}, {b}))) END"


def edit(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE 1 - CAST(levenshtein({a}, {b}) AS DOUBLE) / greatest(length({a}), length({b})) END"


def exact(n: str) -> str:
    return f"CAST(a.{n} = b.{n} AND a.{n} <> '' AS DOUBLE)"


def shingles(e: str, size: int = 3) -> str:
    t = f"('  ' || {e} || '  ')"
    return f"CASE WHEN trim({e}) = '' THEN CAST([] AS VARCHAR[]) ELSE list_distinct(list_transform(range(1, length({t}) - {size} + 2), lambda i: substr({t}, i, {size}))) END"


def soundex(t: str) -> str:
    u = f"upper({t})"
    codes = f"regexp_replace(translate(regexp_replace({u}, '[0-9]', '0', 'g'), 'BFPVCGJKQSXZDTLMNR', '111122222222334556'), '[^1-6]', '0', 'g')"
    for d in "123456":
        codes = f"regexp_replace({codes}, '{d}+', '{d}', 'g')"
    return f"CASE WHEN regexp_matches({u}, '^[A-Z]') THEN rpad(substr({u}, 1, 1) || replace(substr({codes}, 2), '0', ''), 4, '0') ELSE '' END"


def _prepared(source: str) -> str:
    form = "CASE e " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LEGAL_FORMS.items()) + " ELSE '' END"
    out = [f"{source}_0 AS (SELECT *, {norm('business_name')} AS nn, {norm('business_address')} AS na, ' ' || {norm('business_name')} AS r, '' AS f FROM {source})"]
    for i in range(4):
        out.append(
            f"{source}_{i + 1} AS (SELECT * EXCLUDE (r, f, e), CASE WHEN e = '' THEN r ELSE regexp_extract(r, '^(.*?) ({ENDINGS})$', 1) END AS r, "
            f"CASE WHEN e = '' THEN f ELSE trim({form} || ' ' || f) END AS f FROM (SELECT *, regexp_extract(r, '^(.*?) ({ENDINGS})$', 2) AS e FROM {source}_{i}))"
        )
    clauses = "list_filter(list_transform(string_split_regex(regexp_replace(business_address, '\\s+', ' ', 'g'), '[,;]+'), lambda x: trim(x)), lambda x: x <> '')"
    out.append(
        f"{source}_c AS (SELECT *, trim(r) AS brand_name, f AS legal_form, "
        f"array_to_string(list_filter(list_transform({clauses}, lambda x: CASE WHEN regexp_matches(x, '{_MARK}') THEN trim(regexp_extract(x, '^(.*?){_MARK}', 1)) ELSE x END), lambda x: x <> ''), ', ') AS core_raw, "
        f"array_to_string(list_transform(list_filter({clauses}, lambda x: regexp_matches(x, '{_MARK}')), lambda x: regexp_extract(x, '{_MARK}.*$')), ', ') AS landmark_text, "
        f"upper(replace({norm('postal_code')}, ' ', '')) AS given, regexp_extract(business_address, '\\b(?:\\d{{5}}(?:-\\d{{4}})?|\\d{{6}}|\\d{{4,10}})\\b') AS found FROM {source}_4)"
    )
    out.append(
        f"{source}_d AS (SELECT *, {norm('core_raw')} AS core_address, CASE WHEN given <> '' THEN given ELSE found END AS postal_code_normalized, "
        f"{norm('country')} AS country_normalized, {norm('landmark_text')} AS lt FROM {source}_c)"
    )
    tokens = f"CASE WHEN core_address <> '' THEN string_split(core_address, ' ') ELSE {words('na')} END"
    fits = "list_filter(tk[1:4], lambda t: NOT (postal_code_normalized <> '' AND upper(t) = postal_code_normalized) AND NOT regexp_matches(t, '^[0-9]{5,}$') AND regexp_matches(t, '^\\d+[A-Za-z]?$'))"
    out.append(f"{source}_e AS (SELECT *, {tokens} AS tk FROM {source}_d)")
    out.append(f"{source}_f AS (SELECT *, coalesce({fits}[1], '') AS street_number FROM {source}_e)")
    prefix = "CASE WHEN postal_code_normalized = '' THEN '' WHEN country_normalized IN ('france', 'fr') OR (country_normalized = '' AND length(postal_code_normalized) = 5 AND regexp_matches(postal_code_normalized, '^[0-9]{2}')) THEN substr(postal_code_normalized, 1, 2) ELSE substr(postal_code_normalized, 1, 3) END"
    out.append(
        f"{source}_p AS (SELECT id, k, nn AS normalized_business_name, brand_name, legal_form, {words('brand_name')} AS name_tokens, na AS normalized_address, {words('na')} AS address_tokens, "
        f"core_address, landmark_text, {words('lt')} AS landmark_tokens, street_number, array_to_string(list_filter(tk, lambda t: t <> street_number AND NOT (postal_code_normalized <> '' AND upper(t) = postal_code_normalized)), ' ') AS street_name, "
        f"postal_code_normalized, country_normalized, {prefix} AS postal_prefix FROM {source}_f)"
    )
    return ",\n".join(out)


PREPARED = ",\n".join([CTES, *(_prepared(f"source{n}") for n in "123")])
COUNTRY = "(a.country_normalized = '' OR b.country_normalized = '' OR a.country_normalized = b.country_normalized)"


def _signature(source: str, permutations: int = 48) -> str:
    text = "trim(regexp_replace(concat_ws(' ', brand_name, normalized_address, '', '', country_normalized, postal_code_normalized), ' +', ' ', 'g'))"
    least = ", ".join(f"coalesce(list_min(list_transform(h, lambda x: (x * {a} + {b}) % {PRIME})), {PRIME})" for a, b in coefficients(permutations))
    return (
        f"{source}_s AS (SELECT id, country_normalized, [{least}] AS sig FROM (SELECT id, country_normalized, list_transform(g, lambda x: CAST('0x' || substr(md5(x), 1, 7) AS BIGINT)) AS h "
        f"FROM (SELECT id, country_normalized, {shingles('lower(t)')} AS g FROM (SELECT *, {text} AS t FROM {source}_p))))"
    )


def _lsh(target: str, bands: int = 12, rows: int = 4) -> str:
    keys = ", ".join(f"'{i}:' || array_to_string(sig[{i * rows + 1}:{i * rows + rows}], '-')" for i in range(bands))
    side = lambda s: f"(SELECT id, country_normalized, unnest([{keys}]) AS key FROM {s}_s)"
    return f"SELECT DISTINCT a.id AS source1_id, b.id AS target_id, 'minhash' AS method, 0.0 AS weight FROM {side('source1')} a JOIN {side(target)} b ON a.key = b.key AND {COUNTRY} AND a.id <> b.id"


def _token(target: str) -> str:
    post = lambda s: f"(SELECT id, country_normalized, unnest(list_distinct(list_concat(name_tokens, address_tokens))) AS key FROM {s}_p)"
    return (
        f"SELECT a.id AS source1_id, b.id AS target_id, 'token_posting' AS method, ln(CAST((SELECT count(*) FROM {target}_p) + 1 AS DOUBLE) / (d.df + 1)) + 1 AS weight FROM {post('source1')} a JOIN {post(target)} b ON a.key = b.key "
        f"JOIN (SELECT key, count(*) AS df FROM {post(target)} GROUP BY key HAVING count(*) <= 500) d ON d.key = a.key WHERE {COUNTRY} AND a.id <> b.id"
    )


def _field(target: str, field: str, weight: float) -> str:
    return f"SELECT a.id AS source1_id, b.id AS target_id, 'token_posting' AS method, {weight} AS weight FROM source1_p a JOIN {target}_p b ON a.{field} = b.{field} AND a.{field} <> '' AND {COUNTRY} AND a.id <> b.id"


def _evidence(target: str) -> str:
    return " UNION ALL ".join([_lsh(target), _token(target), _field(target, "postal_prefix", 1.5), _field(target, "street_number", 0.5)])


def _candidates(target: str) -> str:
    coarse = f"least(1.0, 0.68 * ({jaccard('a.name_tokens', 'b.name_tokens')}) + 0.20 * ({jaccard('a.address_tokens', 'b.address_tokens')}) + 0.08 * {exact('postal_code_normalized')} + 0.04 * {exact('street_number')})"
    score = f"round(least(1.0, {coarse} * 0.65 + least(u.weight / 10, 0.3) + CASE WHEN len(u.m) = 3 THEN 0.2 WHEN len(u.m) > 1 THEN 0.1 ELSE 0.0 END), 9)"
    return (
        f"SELECT source1_id, '{target}' AS target_source, target_id, m AS blocking_methods, {score} AS blocking_score, a.country_normalized AS source1_country FROM "
        f"(SELECT source1_id, target_id, list_sort(list(DISTINCT method)) AS m, CAST(sum(weight) AS DOUBLE) AS weight FROM ({_evidence(target)}) GROUP BY 1, 2) u JOIN source1_p a ON a.id = u.source1_id JOIN {target}_p b ON b.id = u.target_id"
    )


SIGNED = PREPARED + ",\n" + ",\n".join(_signature(f"source{n}") for n in "123")
CANDIDATES = (
    SIGNED
    + f",\ncands AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY source1_id, target_source ORDER BY blocking_score DESC, target_id) AS rn FROM ({_candidates('source2')} UNION ALL {_candidates('source3')})) WHERE rn <= 8)"
)
TRUTH = "truth AS (SELECT a.id AS source1_id, 'source2' AS target_source, b.id AS target_id FROM source1 a JOIN source2 b ON a.k = b.k UNION ALL SELECT a.id, 'source3', b.id FROM source1 a JOIN source3 b ON a.k = b.k)"
CHAINS = "chains AS (SELECT brand_name FROM (SELECT brand_name FROM source1_p UNION ALL SELECT brand_name FROM source2_p UNION ALL SELECT brand_name FROM source3_p) WHERE brand_name <> '' GROUP BY brand_name HAVING count(*) >= 3)"


def _features() -> str:
    ln, rn = "a.lname", "b.lname"
    w = lambda t: f"coalesce(w.m[{t}], 1.0)"  # noqa: E731, F841
    street = "CASE WHEN a.street_number = '' OR b.street_number = '' THEN 0.0 WHEN a.street_number = b.street_number THEN 1.0 ELSE -1.0 END"
    both = lambda n: f"CAST(a.{n} <> '' AND b.{n} <> '' AS DOUBLE)"
    landmark = f"CASE WHEN len(a.landmark_tokens) > 0 AND len(b.landmark_tokens) > 0 THEN {jaccard('a.landmark_tokens', 'b.landmark_tokens')} ELSE {edit('a.landmark_text', 'b.landmark_text')} END"
    code = lambda x: f"array_to_string(list_filter(list_transform({x}, lambda t: {soundex('t')}), lambda s: s <> ''), ' ')"
    total = lambda s, e: f"coalesce(list_sum(list_transform({s}, lambda t: {e})), 0.0)"
    wt = "coalesce(a.w[t], b.w[t], 1.0)"
    shared = lambda n: f"list_intersect(list_distinct(a.{n}), list_distinct(b.{n}))"
    cosine = lambda n: f"CASE WHEN len(a.{n}) = 0 OR len(b.{n}) = 0 THEN 0.0 ELSE {total(shared(n), f'{wt} * {wt}')} / sqrt({total(f'list_distinct(a.{n})', f'{wt} * {wt}')} * {total(f'list_distinct(b.{n})', f'{wt} * {wt}')}) END"
    union = "list_distinct(list_concat(a.name_tokens, b.name_tokens))"
    f = {
        "name_exact": exact("normalized_business_name"),
        "brand_exact": exact("lname"),
        "name_token_jaccard": jaccard("a.name_tokens", "b.name_tokens"),
        "name_char_jaccard": jaccard("a.grams", "b.grams"),
        "name_edit_similarity": edit(ln, rn),
        "name_token_set_ratio": jaccard("a.name_tokens", "b.name_tokens"),
        "name_phonetic_similarity": edit("a.code", "b.code"),
        "name_tfidf_cosine": cosine("name_tokens"),
        "name_rare_token_similarity": f"CASE WHEN len({union}) = 0 THEN 0.0 ELSE {total(shared('name_tokens'), wt)} / {total(union, wt)} END",
        "name_shared_tokens": f"CAST(len({shared('name_tokens')}) AS DOUBLE)",
        "name_token_count_gap": "CAST(abs(len(list_distinct(a.name_tokens)) - len(list_distinct(b.name_tokens))) AS DOUBLE)",
        "name_length_ratio": f"CASE WHEN {ln} = '' OR {rn} = '' THEN 0.0 ELSE CAST(least(length({ln}), length({rn})) AS DOUBLE) / greatest(length({ln}), length({rn})) END",
        "legal_form_exact": exact("legal_form"),
        "legal_form_present_both": both("legal_form"),
        "address_token_jaccard": jaccard("a.address_tokens", "b.address_tokens"),
        "address_edit_similarity": edit("a.normalized_address", "b.normalized_address"),
        "address_tfidf_cosine": cosine("address_tokens"),
        "street_number_exact": street,
        "street_number_present_both": both("street_number"),
        "postal_exact": exact("postal_code_normalized"),
        "postal_prefix_match": "CAST(length(a.postal_code_normalized) >= 2 AND length(b.postal_code_normalized) >= 2 AND substr(a.postal_code_normalized, 1, 2) = substr(b.postal_code_normalized, 1, 2) AS DOUBLE)",
        "city_exact": "0.0",
        "region_exact": "0.0",
        "country_exact": exact("country_normalized"),
        "country_present_both": both("country_normalized"),
        "street_name_similarity": edit("a.street_name", "b.street_name"),
        "landmark_similarity": landmark,
        "name_postal_interaction": f"({edit(ln, rn)}) * {exact('postal_code_normalized')}",
        "name_street_number_interaction": f"({edit(ln, rn)}) * CASE WHEN ({street}) = 1 THEN 1.0 ELSE 0.0 END",
        "moderate_name_address_interaction": f"least({edit(ln, rn)}, {jaccard('a.address_tokens', 'b.address_tokens')})",
        "multiple_blockers_agree": "CAST(len(c.blocking_methods) > 1 AS DOUBLE)",
        "minhash_blocked": "CAST(list_contains(c.blocking_methods, 'minhash') AS DOUBLE)",
        "token_blocked": "CAST(list_contains(c.blocking_methods, 'token_posting') AS DOUBLE)",
        "dense_blocked": "CAST(list_contains(c.blocking_methods, 'dense') AS DOUBLE)",
        "blocking_score": "c.blocking_score",
        "is_chain": "CAST(a.chain OR b.chain AS DOUBLE)",
        "name_missing_either": f"CAST({ln} = '' OR {rn} = '' AS DOUBLE)",
        "address_missing_either": "CAST(a.normalized_address = '' OR b.normalized_address = '' AS DOUBLE)",
    }
    assert tuple(f) == FEATURES
    wide = (
        f"wide AS (SELECT p.*, CASE WHEN p.brand_name <> '' THEN p.brand_name ELSE p.normalized_business_name END AS lname, {shingles('(CASE WHEN p.brand_name <> $$$$ THEN p.brand_name ELSE p.normalized_business_name END)')} AS grams, "
        f"{code('p.name_tokens')} AS code, p.brand_name IN (SELECT brand_name FROM chains) AS chain, w.w FROM (SELECT * FROM source1_p UNION ALL SELECT * FROM source2_p UNION ALL SELECT * FROM source3_p) p LEFT JOIN wmap w ON w.id = p.id)"
    )
    maps = "wmap AS (SELECT id, map_from_entries(list(struct_pack(k := token, v := idf))) AS w FROM (SELECT id, unnest(list_distinct(list_concat(name_tokens, address_tokens))) AS token FROM (SELECT * FROM source1_p UNION ALL SELECT * FROM source2_p UNION ALL SELECT * FROM source3_p)) JOIN idf USING (token) GROUP BY id)"
    cols = ", ".join(f"round(CAST({e} AS DOUBLE), 6) AS {n}" for n, e in f.items())
    return f"{CHAINS}, {IDF}, {maps}, {wide}, feats AS (SELECT c.source1_id, c.target_source, c.target_id, {cols} FROM cands c JOIN wide a ON a.id = c.source1_id JOIN wide b ON b.id = c.target_id)"


IDF = "idf AS (SELECT token, count(*) AS df, ln(CAST((SELECT count(*) FROM source1_p WHERE len(name_tokens) + len(address_tokens) > 0) + 1 AS DOUBLE) / (count(*) + 1)) + 1 AS idf FROM (SELECT unnest(list_distinct(list_concat(name_tokens, address_tokens))) AS token FROM source1_p) GROUP BY token)"
FEATS = CANDIDATES + ",\n" + _features()
ALL_P = "(SELECT * FROM source1_p UNION ALL SELECT * FROM source2_p UNION ALL SELECT * FROM source3_p)"
WINNER = "SELECT source1_id, target_source, target_id, confidence FROM (SELECT *, row_number() OVER (PARTITION BY target_source, {} ORDER BY confidence DESC, source1_id, target_id) AS rn FROM (SELECT source1_id, target_source, target_id, blocking_score AS confidence FROM cands)) WHERE rn = 1"
MATCHED = "matched AS (SELECT * FROM (" + WINNER.format("target_id") + ") WHERE confidence > 0.6)"


def _sweep(steps: int) -> str:
    return f"""thr AS (SELECT 0.5 + (0.99 - 0.5) * CAST(i AS DOUBLE) / {steps - 1} AS threshold FROM (SELECT unnest(range({steps})) AS i)),
best AS ({WINNER.format('target_id')}),
pred AS (SELECT t.threshold, b.source1_id, b.target_source, b.target_id, h.source1_id IS NOT NULL AS hit FROM best b JOIN thr t ON b.confidence > t.threshold LEFT JOIN truth h ON h.source1_id = b.source1_id AND h.target_source = b.target_source AND h.target_id = b.target_id),
per AS (SELECT threshold, source1_id, count(*) AS np, count(*) FILTER (WHERE hit) AS tp FROM pred GROUP BY 1, 2),
ent AS (SELECT t.threshold, s.id AS source1_id, coalesce(g.nt, 0) AS nt, coalesce(p.np, 0) AS np, coalesce(p.tp, 0) AS tp FROM source1 s CROSS JOIN thr t LEFT JOIN (SELECT source1_id, count(*) AS nt FROM truth GROUP BY 1) g ON g.source1_id = s.id LEFT JOIN per p ON p.source1_id = s.id AND p.threshold = t.threshold),
hist AS (SELECT threshold, round(avg(CASE WHEN nt = 0 AND np = 0 THEN 1.0 WHEN nt = 0 OR np = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (CAST(tp AS DOUBLE) / np) * (CAST(tp AS DOUBLE) / nt) / (0.25 * (CAST(tp AS DOUBLE) / np) + CAST(tp AS DOUBLE) / nt) END), 6) AS macro_fbeta,
  CAST(sum(np) AS BIGINT) AS np, CAST(sum(tp) AS BIGINT) AS tp, (SELECT count(*) FROM truth) AS nt, count(*) AS entities FROM ent GROUP BY threshold),
history AS (SELECT round(threshold, 4) AS threshold, macro_fbeta, round(CASE WHEN np = 0 THEN CASE WHEN nt = 0 THEN 1.0 ELSE 0.0 END ELSE CAST(tp AS DOUBLE) / np END, 6) AS micro_precision, round(CAST(tp AS DOUBLE) / nt, 6) AS micro_recall,
  tp AS true_positives, np - tp AS false_positives, nt - tp AS false_negatives, entities, np AS predicted FROM hist)"""


def _keyed(mode: str) -> str:
    drop = ", ".join(f"'{w}'" for w in COMMON_WORDS)
    plain = "business_name" if mode == "simple" else r"regexp_replace(lower(business_name), '(@|www\.|\.com|\.in|\.fr|\.org|\.net|\bthe\b|\bmr\b|\bmrs\b|\bms\b)', ' ', 'g')"
    least = 3 if mode == "simple" else 2
    tokens = f"list_filter(regexp_extract_all(lower({plain}), '[a-z0-9]+'), lambda w: length(w) >= {least} AND w NOT IN ({drop}))"
    num = r"regexp_extract(business_address, '\b\d+\b')"
    if mode == "strict":
        num = f"CASE WHEN regexp_matches({num}, '^0+$') THEN '0' ELSE regexp_replace({num}, '^0+', '') END"
    us = ", ".join(f"'{s}'" for s in US_STATES)
    squeezed = "replace(replace(replace(lower(business_address), ' ', ''), '.', ''), ',', '')"
    india = "CASE " + " ".join(f"WHEN contains({squeezed}, '{s}') THEN '{s}'" for s in sorted(INDIAN_STATES, key=lambda s: (-len(s), s))) + " ELSE '' END"
    state = rf"CASE lower(trim(country)) WHEN 'us' THEN coalesce(list_filter(regexp_extract_all(upper(business_address), '\b[A-Z]{{2}}\b'), lambda c: c IN ({us}))[-1], '') WHEN 'india' THEN {india} WHEN 'france' THEN regexp_extract(upper(business_address), '\b(0[1-9]|[1-8][0-9]|9[0-8]|2A|2B)\b', 1) ELSE '' END"
    one = lambda s: f"SELECT '{s}' AS src, id, k AS pos, lower(trim(country)) AS c, {tokens} AS t, {num} AS num, {state} AS st FROM {s}"
    ns, two = "CASE WHEN len(t) > 0 AND num <> '' THEN c || '#ns#' || t[1] || '#' || num END", "CASE WHEN len(t) >= 2 THEN c || '#n2#' || t[1] || '#' || t[2] END"
    third = "CASE WHEN len(t) = 1 THEN c || '#n1#' || t[1] END" if mode == "simple" else "CASE WHEN array_to_string(t, '') <> '' THEN c || '#ex#' || array_to_string(t, '') END"
    keys = f"[{ns}, {two}, {third}]" if mode == "simple" else f"[{third}, {ns}, {two}]"
    cap = 4 if mode == "simple" else 5
    g = lambda x: f"list_distinct(list_transform(range(1, length({x}) - 1), lambda i: substr({x}, i, 3)))"
    near = f"CASE WHEN cs = '' OR tcs = '' THEN 0.0 WHEN length(cs) < 3 OR length(tcs) < 3 THEN CASE WHEN cs = tcs THEN 1.0 ELSE 0.0 END ELSE {jaccard(g('cs'), g('tcs'))} END"
    verified = (
        f"(st = '' OR tst = '' OR st = tst) AND (num = '' OR tnum = '' OR starts_with(num, tnum) OR starts_with(tnum, num)) AND ((cs <> '' AND cs = tcs) OR coalesce(num <> '' AND num = tnum AND len(t) > 0 AND len(tt) > 0 AND (t[1] = tt[1] OR ({near}) >= 0.5), false) "
        f"OR ({jaccard('t', 'tt[1:3]')}) >= 0.6 OR (length(cs) >= 5 AND length(tcs) >= 5 AND ({near}) >= 0.75))"
    )
    high = "WHERE prio < 3 OR source1_id NOT IN (SELECT source1_id FROM hits WHERE prio < 3)" if mode == "simple" else ""
    return f"""WITH {CTES},
d AS ({one('source1')} UNION ALL {one('source2')} UNION ALL {one('source3')}),
kk AS (SELECT *, array_to_string(t, '') AS cs, unnest({keys}) AS key, unnest([1, 2, 3]) AS prio FROM d),
ks AS (SELECT * FROM kk WHERE key IS NOT NULL),
listed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src, key ORDER BY pos) AS place FROM ks WHERE src <> 'source1') WHERE place <= 4),
hits AS (SELECT a.id AS source1_id, b.src AS target_source, b.id AS target_id, a.prio, b.place, a.t, a.cs, a.num, a.st, b.t AS tt, b.cs AS tcs, b.num AS tnum, b.st AS tst FROM ks a JOIN listed b ON a.key = b.key WHERE a.src = 'source1'),
good AS (SELECT * FROM hits {high}),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source1_id, target_source, target_id ORDER BY prio, place) AS o FROM good) WHERE o = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source1_id, target_source ORDER BY prio, place) AS rank FROM once)
SELECT source1_id, target_source, target_id, rank, {'rank <= 2' if mode == 'simple' else verified} AS matched FROM ranked WHERE rank <= {cap}"""


_ROUTED = "concat('BP ', CAST(c_custkey % 900 AS STRING), ', ', CAST(c_nationkey AS STRING), ' Rue de la Paix, 75', lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'), ' Paris Cedex ', lpad(CAST(c_custkey % 20 AS STRING), 2, '0'))"
ROUTED = f"SELECT c_custkey, {_ROUTED} AS address FROM {{customer}}"
_RAWNUM = r"list_concat(regexp_extract_all(regexp_extract(address, '(?i)\bcedex(?:\s*\d+)?\b'), '\d+'), regexp_extract_all(regexp_extract(address, '(?i)\bbp\s*\d+\b'), '\d+'))"

SQL = {
    "directory": f"WITH {CTES} SELECT * FROM source1 UNION ALL SELECT * FROM source2 UNION ALL SELECT * FROM source3",
    "name_normalize": f"WITH {PREPARED} SELECT id, normalized_business_name, brand_name, legal_form FROM {ALL_P}",
    "address_parse": f"WITH {PREPARED} SELECT id, normalized_address, core_address, landmark_text, street_number, street_name, postal_code_normalized, country_normalized, postal_prefix FROM {ALL_P}",
    "routing_extract": rf"""SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace(address, '(?i)\bcedex(?:\s*\d+)?\b', ' ', 'g'), '(?i)\bbp\s*\d+\b', ' ', 'g'), '\s+', ' ', 'g')) AS cleaned,
  regexp_extract(address, '(?i)\bcedex(?:\s*\d+)?\b') || ' ' || regexp_extract(address, '(?i)\bbp\s*\d+\b') AS routing,
  array_to_string(list_sort(list_distinct(list_concat({_RAWNUM}, list_transform({_RAWNUM}, lambda n: CASE WHEN regexp_matches(n, '^0+$') THEN '0' ELSE regexp_replace(n, '^0+', '') END)))), ',') AS numbers FROM ({ROUTED.format(customer='customer')})""",
    "soundex_codes": f"SELECT token, {soundex('token')} AS code FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(p_name || ' ' || p_type), '[a-z0-9]+')) AS token FROM part)",
    "phonetic_similarity": f"SELECT x.a, x.b, round({edit('ca', 'cb')}, 6) AS similarity FROM (SELECT a.n AS a, b.n AS b, {soundex('a.n')} AS ca, {soundex('b.n')} AS cb FROM (SELECT DISTINCT string_split(p_name, ' ')[1] AS n FROM part) a JOIN (SELECT DISTINCT string_split(p_name, ' ')[2] AS n FROM part) b ON substr(a.n, 1, 1) = substr(b.n, 1, 1)) x",
    "shingles": f"SELECT p_name, array_to_string(list_sort({shingles('p_name')}), '|') AS grams FROM (SELECT DISTINCT p_name FROM part)",
    "minhash_signature": f"WITH {SIGNED} SELECT id, array_to_string(sig, '-') AS signature FROM source1_s",
    "lsh_pairs": f"WITH {SIGNED} SELECT source1_id, target_id FROM ({_lsh('source2')})",
    "idf_table": f"WITH {PREPARED}, {IDF} SELECT token, df, round(idf, 6) AS idf FROM idf",
    "token_candidates": f"WITH {PREPARED} SELECT source1_id, target_id, round(CAST(sum(weight) AS DOUBLE), 6) AS weight FROM ({_token('source2')}) GROUP BY 1, 2",
    "postal_candidates": f"WITH {PREPARED} SELECT source1_id, target_id FROM ({_field('source3', 'postal_prefix', 1.5)})",
    "street_candidates": f"WITH {PREPARED} SELECT source1_id, target_id FROM ({_field('source3', 'street_number', 0.5)})",
    "dense_topk": "SELECT source1_id, target_id, weight FROM (SELECT *, row_number() OVER (PARTITION BY source1_id ORDER BY weight DESC, target_id) AS rn FROM (SELECT a.vec_id AS source1_id, b.vec_id AS target_id, round(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: CAST(a.embedding[i] AS DOUBLE) * CAST(b.embedding[i] AS DOUBLE))), 6) AS weight FROM embeddings a JOIN embeddings b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)) WHERE rn <= 20",
    "blocking_topk": f"WITH {CANDIDATES} SELECT source1_id, target_source, target_id, array_to_string(blocking_methods, ',') AS blocking_methods, round(blocking_score, 6) AS blocking_score, source1_country FROM cands",
    "blocking_stats": f"""WITH {CANDIDATES}, {TRUTH}, per AS (SELECT source1_id, count(*) AS n FROM cands GROUP BY 1)
SELECT count(*) AS total_candidates, count(*) FILTER (WHERE list_contains(blocking_methods, 'dense')) AS dense_candidates, count(*) FILTER (WHERE list_contains(blocking_methods, 'minhash')) AS minhash_candidates, count(*) FILTER (WHERE list_contains(blocking_methods, 'token_posting')) AS token_candidates,
  count(*) FILTER (WHERE len(list_intersect(blocking_methods, ['minhash', 'token_posting'])) = 2) AS overlap_minhash_token, count(*) FILTER (WHERE len(list_intersect(blocking_methods, ['minhash', 'dense'])) = 2) AS overlap_minhash_dense, count(*) FILTER (WHERE len(list_intersect(blocking_methods, ['token_posting', 'dense'])) = 2) AS overlap_token_dense, count(*) FILTER (WHERE len(blocking_methods) = 3) AS overlap_all,
  (SELECT round(avg(n), 6) FROM per) AS mean_per_source1, (SELECT median(n) FROM per) AS median_per_source1, (SELECT quantile_disc(n, 0.95) FROM per) AS p95_per_source1, (SELECT max(n) FROM per) AS max_per_source1,
  round(CAST((SELECT count(*) FROM truth SEMI JOIN cands USING (source1_id, target_source, target_id)) AS DOUBLE) / (SELECT count(*) FROM truth), 6) AS recall, (SELECT count(*) FROM truth ANTI JOIN cands USING (source1_id, target_source, target_id)) AS missed FROM cands""",
    "pair_features": f"WITH {FEATS} SELECT * FROM feats",
    "rule_scores": f"""WITH {FEATS} SELECT source1_id, target_source, target_id, CASE WHEN is_chain = 0 AND name_exact = 1 AND postal_exact = 1 AND country_exact = 1 AND street_number_exact = 1 THEN 'exact_name_postal_number_country' WHEN is_chain = 0 AND brand_exact = 1 AND street_number_exact = 1 AND street_name_similarity >= 0.82 AND country_exact = 1 THEN 'exact_brand_street_address_country' ELSE '' END AS rule_applied FROM feats""",
    "hard_negatives": f"""WITH {FEATS}, {TRUTH}, lab AS (SELECT f.source1_id, f.target_source, f.target_id, CASE WHEN t.source1_id IS NULL THEN 0 ELSE 1 END AS label, round(0.35 * name_edit_similarity + 0.25 * name_token_set_ratio + 0.2 * postal_exact + 0.2 * blocking_score, 9) AS difficulty FROM feats f LEFT JOIN truth t USING (source1_id, target_source, target_id))
SELECT source1_id, target_source, target_id, label FROM lab WHERE label = 1 UNION ALL SELECT source1_id, target_source, target_id, label FROM (SELECT *, row_number() OVER (ORDER BY difficulty DESC, source1_id, target_source, target_id) AS rn FROM lab WHERE label = 0) WHERE rn <= greatest((SELECT 10 * count(*) FROM lab WHERE label = 1), 50)""",
    "chain_brands": f"WITH {PREPARED} SELECT brand_name, count(*) AS n FROM {ALL_P} WHERE brand_name <> '' GROUP BY 1 HAVING count(*) >= 3",
    "truth_normalize": f"WITH {CTES}, {TRUTH} SELECT * FROM truth",
    "cardinality_infer": f"""WITH {CTES}, g AS (SELECT a.id AS source1_id, 'source2' AS target_source, b.id AS target_id FROM source1 a JOIN source2 b ON a.business_name = lower(replace(b.business_name, ' LIMITED', '')) || ' Ltd' UNION ALL SELECT a.id, 'source3', b.id FROM source1 a JOIN source3 b ON a.k = b.k)
SELECT s AS target_source, CASE WHEN coalesce(x, false) AND coalesce(y, false) THEN 'many_to_many' WHEN coalesce(x, false) THEN 'one_to_many' WHEN coalesce(y, false) THEN 'many_to_one' ELSE 'one_to_one' END AS cardinality FROM (SELECT unnest(['source2', 'source3']) AS s) LEFT JOIN (SELECT target_source, bool_or(n > 1) AS x FROM (SELECT target_source, source1_id, count(DISTINCT target_id) AS n FROM g GROUP BY 1, 2) GROUP BY 1) p ON p.target_source = s LEFT JOIN (SELECT target_source, bool_or(n > 1) AS y FROM (SELECT target_source, target_id, count(DISTINCT source1_id) AS n FROM g GROUP BY 1, 2) GROUP BY 1) q ON q.target_source = s""",
    "split_holdout": f"WITH {CTES} SELECT id, row_number() OVER (ORDER BY md5('42|' || id), id) <= greatest(1, CAST(round_even(count(*) OVER () * 0.2, 0) AS BIGINT)) AS validation FROM source1",
    "unique_target_winner": f"WITH {CANDIDATES} {WINNER.format('target_id')}",
    "unique_s1_winner": f"WITH {CANDIDATES} {WINNER.format('source1_id')}",
    "threshold_sweep": f"WITH {CANDIDATES}, {TRUTH}, {_sweep(50)} SELECT * FROM history",
    "tune_threshold": f"WITH {CANDIDATES}, {TRUTH}, {_sweep(50)} SELECT * FROM history ORDER BY macro_fbeta DESC, micro_precision DESC, threshold LIMIT 1",
    "macro_fbeta": f"WITH {CANDIDATES}, {TRUTH}, {_sweep(50)} SELECT macro_fbeta, micro_precision, micro_recall, true_positives, false_positives, false_negatives, entities FROM history WHERE threshold = 0.6",
    "diagnostics": f"""WITH {CANDIDATES}, {TRUTH}, {MATCHED} SELECT 'false_positives' AS kind, '' AS value, count(*) AS n FROM matched ANTI JOIN truth USING (source1_id, target_source, target_id) UNION ALL SELECT 'false_negatives', '', count(*) FROM truth ANTI JOIN matched USING (source1_id, target_source, target_id) UNION ALL SELECT 'missed_by_blocking', '', count(*) FROM truth ANTI JOIN cands USING (source1_id, target_source, target_id)
UNION ALL SELECT 'candidates_by_country', CASE WHEN source1_country = '' THEN '(missing)' ELSE source1_country END, count(*) FROM cands GROUP BY 2 UNION ALL SELECT 'candidates_by_method', m, count(*) FROM (SELECT unnest(blocking_methods) AS m FROM cands) GROUP BY 2""",
    "submission_matches": f"WITH {CANDIDATES}, {MATCHED} SELECT s.id AS source1_entity_id, coalesce((SELECT string_agg(DISTINCT target_id, ',' ORDER BY target_id) FROM matched m WHERE m.source1_id = s.id), '') AS matched_entity_ids FROM source1 s",
    "submission_candidates": f"WITH {CANDIDATES} SELECT s.id AS source1_entity_id, coalesce((SELECT string_agg(DISTINCT target_id, ',' ORDER BY target_id) FROM cands m WHERE m.source1_id = s.id), '') AS candidate_entity_ids FROM source1 s",
    "submission_validate": f"""WITH {CANDIDATES}, won AS ({WINNER.format('target_id')}),
m AS (SELECT s.id AS s1, (SELECT string_agg(DISTINCT target_id, ',' ORDER BY target_id) FROM won w WHERE w.source1_id = s.id) AS ids FROM source1 s),
i AS (SELECT s1, unnest(string_split(ids, ',')) AS i FROM m WHERE ids IS NOT NULL),
f AS (SELECT 'duplicate_row' AS finding, s1 AS x FROM m GROUP BY s1 HAVING count(*) > 1
UNION ALL SELECT 'repeated_in_list', s1 FROM i GROUP BY s1, i HAVING count(*) > 1
UNION ALL SELECT 'source1_in_list', i FROM i WHERE starts_with(i, 'S1-')
UNION ALL SELECT 'wrong_prefix', i FROM i WHERE NOT regexp_matches(i, '^S[123]-')
UNION ALL SELECT 'unknown_id', i FROM i WHERE regexp_matches(i, '^S[23]-') AND i NOT IN (SELECT id FROM source2 UNION ALL SELECT id FROM source3)
UNION ALL SELECT 'missing_entity', id FROM source1 WHERE id NOT IN (SELECT s1 FROM m)
UNION ALL SELECT 'extra_entity', s1 FROM m WHERE s1 NOT IN (SELECT id FROM source1)
UNION ALL SELECT 'not_a_candidate', s1 FROM i WHERE (s1, i) NOT IN (SELECT (source1_id, target_id) FROM cands))
SELECT n.finding, count(DISTINCT f.x) AS n, coalesce(array_to_string(list_sort(list(DISTINCT f.x) FILTER (WHERE f.x IS NOT NULL))[1:5], ','), '') AS examples
FROM (SELECT unnest(['duplicate_row', 'repeated_in_list', 'source1_in_list', 'wrong_prefix', 'unknown_id', 'missing_entity', 'extra_entity', 'not_a_candidate']) AS finding) n LEFT JOIN f USING (finding) GROUP BY n.finding""",
    "output_integrity": f"""WITH {CANDIDATES}, won AS ({WINNER.format('target_id')})
SELECT (SELECT count(*) FROM (SELECT 1 FROM cands GROUP BY source1_id, target_source, target_id HAVING count(*) > 1)) AS duplicate_candidates,
  (SELECT count(*) FROM (SELECT 1 FROM won GROUP BY source1_id, target_source, target_id HAVING count(*) > 1)) AS duplicate_matches,
  (SELECT count(*) FROM (SELECT 1 FROM cands GROUP BY source1_id HAVING count(*) > 60)) AS over_cap,
  (SELECT count(*) FROM won ANTI JOIN cands USING (source1_id, target_source, target_id)) AS matches_not_candidates,
  (SELECT count(*) FROM cands WHERE source1_id NOT IN (SELECT id FROM source1)) AS unknown_source1,
  (SELECT count(*) FROM cands WHERE target_id NOT IN (SELECT id FROM source2 UNION ALL SELECT id FROM source3)) AS unknown_target""",
    "evaluation_rates": f"""WITH {CANDIDATES}, {TRUTH}, {MATCHED},
n AS (SELECT (SELECT count(*) FROM truth) AS t, (SELECT count(*) FROM truth SEMI JOIN cands USING (source1_id, target_source, target_id)) AS found, (SELECT count(*) FROM cands) AS c, (SELECT count(*) FROM matched) AS p,
  (SELECT count(*) FROM matched ANTI JOIN truth USING (source1_id, target_source, target_id)) AS wrong, (SELECT count(*) FROM source1) AS e, (SELECT count(*) FROM source1 WHERE id NOT IN (SELECT source1_id FROM matched)) AS alone)
SELECT CASE WHEN t = 0 THEN 1.0::DOUBLE ELSE round(found / t, 6) END AS candidate_recall, round(wrong / greatest(c, 1), 6) AS false_positive_rate, round(wrong / greatest(p, 1), 6) AS false_merge_rate, round(alone / greatest(e, 1), 6) AS unmatched_rate, alone AS unmatched_entities, c AS candidate_count, round(c / greatest(e, 1), 6) AS average_candidates_per_source1 FROM n""",
    "keyed_match_simple": _keyed("simple"),
    "keyed_match_strict": _keyed("strict"),
    "schema_summary": f"WITH {CTES} " + " UNION ALL ".join(f"SELECT '{s}' AS source, count(*) AS n_rows, count(*) FILTER (WHERE business_name = '') AS missing_business_name, count(*) FILTER (WHERE business_address = '') AS missing_business_address, count(*) FILTER (WHERE postal_code = '') AS missing_postal_code, count(*) FILTER (WHERE country = '') AS missing_country FROM {s}" for s in ("source1", "source2", "source3")),
    "bounded_load": f"WITH {CTES}, need AS (SELECT id FROM source1 WHERE k % 10 = 3) SELECT id, k FROM source1 SEMI JOIN need USING (id) UNION ALL SELECT id, k FROM (SELECT id, k, row_number() OVER (ORDER BY k) AS rn FROM source1 ANTI JOIN need USING (id)) WHERE rn <= 100",
}
SQL = {k: v.replace("$$$$", "''") for k, v in SQL.items()}
