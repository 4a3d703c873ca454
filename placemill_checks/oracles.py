"""Plain SQL for each query, written independently: brute force where the operators use grids or indexes."""

from __future__ import annotations

from placemill import vocab
from placemill_checks import views


def _plain(sql: str) -> str:
    return sql.replace("{orders}", "orders").replace("{customer}", "customer").replace("{nation}", "nation").strip()


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _case(name: str, other: str = "") -> str:
    whens = " ".join(
        f"WHEN {' OR '.join(f'{name} LIKE {p!r}' for p in likes)} THEN '{chain}'" for chain, likes in vocab.CHAIN_PATTERNS)
    return f"CASE {whens} {other} END"


_SPACE = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _squeeze(c: str) -> str:
    return f"regexp_replace({c}, '{_SPACE}+', '', 'g')"


def _day(y: str, m: str, d: str) -> str:
    return f"coalesce(CAST(TRY_CAST(lpad(CAST({y} AS VARCHAR), 4, '0') || '-' || {m} || '-' || {d} AS DATE) AS VARCHAR), '')"


def _date(c: str) -> str:
    s = f"split_part({_strip(c)}, ' ', 1)"
    iso, era = r"([0-9]{4})[/\-.]([0-9]{1,2})[/\-.]([0-9]{1,2})", \
        r"([MTSHR明大昭平令][^0-9]*)([0-9]{1,2})[/\-.年]([0-9]{1,2})[/\-.月]([0-9]{1,2})日?"
    part = lambda pattern, i: f"regexp_extract({s}, '{pattern}', {i})"
    key = f"CASE WHEN {part(era, 1)} SIMILAR TO '[MTSHR].*' THEN {part(era, 1)}[1:1] ELSE {part(era, 1)}[1:2] END"
    base = f"CASE {key} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in vocab.ERA_BASE) + " END"
    return f"""CASE
      WHEN {_strip(c)} = '' OR lower({_strip(c)}) IN ('nan', 'none', '-', '—') THEN ''
      WHEN regexp_full_match({s}, '[0-9]{{4,5}}') AND TRY_CAST({s} AS INTEGER) BETWEEN 20000 AND 60000
        THEN CAST(DATE '1899-12-30' + TRY_CAST({s} AS INTEGER) AS VARCHAR)
      WHEN regexp_full_match({s}, '{iso}') THEN {_day(part(iso, 1), part(iso, 2), part(iso, 3))}
      WHEN regexp_full_match({s}, '{era}') AND ({base}) IS NOT NULL
        THEN {_day(f"(({base}) + TRY_CAST({part(era, 2)} AS INTEGER))", part(era, 3), part(era, 4))}
      ELSE '' END"""


_TAGS = "string_split(alt_csv, ',')"
_NOISE = (
    f"(alt_csv IS NOT NULL AND len(list_intersect({_TAGS}, [{_list(vocab.NOISE_TAGS)}])) > 0"
    f" AND len(list_intersect({_TAGS}, [{_list(vocab.FOOD_TAGS)}])) = 0)"
    + "".join(f" OR name ILIKE '{p}'" for p in vocab.NOISE_NAME_PATTERNS)
)
_BUCKET = ("CASE category WHEN 'supermarket' THEN 'super' WHEN 'convenience_store' THEN 'conv' WHEN 'drugstore' THEN 'drug'"
           " WHEN 'grocery_store' THEN 'grocery' ELSE 'fresh' END")
_LAYER_COLUMNS = ("id, name, category, replace(alt_csv, ',', '|') AS category_alt, confidence, brand_wikidata, brand_name, "
                  "operating_status, country, region, locality, address, lon, lat, chain, dedup_method")


def _near_deg(a: str, b: str) -> str:
    return (f"({a}.lon-{b}.lon)*({a}.lon-{b}.lon) + ({a}.lat-{b}.lat)*({a}.lat-{b}.lat)"
            f" <= {vocab.DUPLICATE_DEGREES!r}::DOUBLE * {vocab.DUPLICATE_DEGREES!r}::DOUBLE")


_METRES = ("sqrt(pow((b.lon - g.lon) * 111320.0::DOUBLE * cos(radians(g.lat)), 2)"
           " + pow((b.lat - g.lat) * 110540.0::DOUBLE, 2))")


def _inside(points: str, edges: str, keys: str, prefilter: str = "") -> str:
    """Every edge is tested for every point."""
    c = "((e.bx - e.ax) * (p.lat - e.ay) - (p.lon - e.ax) * (e.by_ - e.ay))"
    return f"""
    SELECT {keys}, e.pref FROM {points} p JOIN {edges} e ON true {prefilter}
    GROUP BY {keys}, e.pref
    HAVING count(*) FILTER (WHERE (e.ay > p.lat) <> (e.by_ > p.lat) AND CASE WHEN e.by_ > e.ay THEN {c} > 0 ELSE {c} < 0 END) % 2 = 1
      AND count(*) FILTER (WHERE {c} = 0 AND p.lon BETWEEN least(e.ax, e.bx) AND greatest(e.ax, e.bx)
                           AND p.lat BETWEEN least(e.ay, e.by_) AND greatest(e.ay, e.by_)) = 0"""


def _area_edges() -> str:
    sides = []
    for s in ("half", "hole"):
        corners = [(f"mx - {s}", "my"), ("mx", f"my - {s}"), (f"mx + {s}", "my"), ("mx", f"my + {s}"), (f"mx - {s}", "my")]
        sides += [f"SELECT pref, {a[0]} AS ax, {a[1]} AS ay, {b[0]} AS bx, {b[1]} AS by_,"
                  " mx - half AS west, mx + half AS east, my - half AS south, my + half AS north FROM area"
                  for a, b in zip(corners, corners[1:])]
    return " UNION ALL ".join(sides)


_OSM_BUCKET = "CASE " + " ".join(
    f"WHEN lower(shop) IN ({_list(tags)}){f" OR lower(amenity) = '{vocab.FRESH_AMENITY}'" if bucket == 'fresh' else ''} THEN '{bucket}'"
    for bucket, tags in vocab.SHOP_BUCKET) + " END"

_CTE = {
    "place": _plain(views.PLACE),
    "raw_place": views.RAW_PLACE.strip(),
    "osm": _plain(views.COMMUNITY),
    "region_edges": views.REGION_EDGES.strip(),
    "area": _plain(views.AREA),
    "area_edges": _area_edges(),
    "reg_a": _plain(views.REGISTER_A),
    "reg_b": _plain(views.REGISTER_B),
    "best": "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{p}')" for c, p in vocab.CHAIN_PROVIDER) + ") AS t(chain, best_provider)",
    "layer": f"""
      SELECT b.*, CASE WHEN b.chain IS NULL THEN 'as-is' ELSE 'best-provider' END AS dedup_method
      FROM (SELECT *, {_case('name')} AS chain FROM place
            WHERE country = 'JP' AND category NOT IN ('pharmacy', 'discount_store', 'department_store')) b
      LEFT JOIN best ON b.chain = best.chain
      WHERE b.chain IS NULL OR b.provider = best.best_provider""",
    "shops": f"""
      SELECT id, lon, lat, {_case('name', f"ELSE '{vocab.OTHER_CHAIN}'")} AS chain, name LIKE '%店' AS branded
      FROM place WHERE category = 'convenience_store'""",
    "dup": f"SELECT DISTINCT g.id FROM shops g JOIN shops b ON g.chain = b.chain WHERE NOT g.branded AND b.branded AND {_METRES} <= 50",
    "osm_fresh": """
      SELECT 'fresh_food' AS cat, name, NULL::VARCHAR AS brand, 'osm' AS src, TRY_CAST(lon_s AS DOUBLE) AS lon, TRY_CAST(lat_s AS DOUBLE) AS lat
      FROM osm WHERE shop IN ('greengrocer', 'butcher', 'seafood')""",
    "comparison": f"""
      SELECT s.ord, s.bucket, s.label, coalesce(a.n, 0) AS primary_n, coalesce(b.n, 0) AS secondary_n, coalesce(a.n, 0) - coalesce(b.n, 0) AS diff
      FROM (VALUES {', '.join(f"({i}, '{b}', '{label}')" for i, (b, label) in enumerate(vocab.BUCKETS, 1))}) AS s(ord, bucket, label)
      LEFT JOIN (SELECT {_BUCKET} AS bucket, count(*) AS n FROM layer GROUP BY 1) a ON s.bucket = a.bucket
      LEFT JOIN (SELECT {_OSM_BUCKET} AS bucket, count(*) AS n FROM osm GROUP BY 1) b ON s.bucket = b.bucket""",
}


def _fresh_and_grocery(source: str) -> dict[str, str]:
    return {
        "gc": f"SELECT 'supermarket' AS cat, name, brand_name AS brand, 'overture' AS src, lon, lat FROM {source}"
              f" WHERE category = 'grocery_store' AND NOT ({_NOISE})",
        "gc_uniq": f"SELECT * FROM gc g WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE s.category = 'supermarket' AND {_near_deg('g', 's')})",
        "fresh_uniq": f"SELECT * FROM osm_fresh g WHERE NOT EXISTS (SELECT 1 FROM {source} s"
                      f" WHERE s.category IN ('butcher_shop', 'seafood_market') AND {_near_deg('g', 's')})",
    }


_MASTER = {
    **_fresh_and_grocery("layer"),
    "cand": """
      SELECT CASE category WHEN 'supermarket' THEN 'supermarket' WHEN 'convenience_store' THEN 'convenience'
                           WHEN 'drugstore' THEN 'drugstore' ELSE 'fresh_food' END AS cat,
             name, brand_name AS brand, 'overture' AS src, lon, lat
      FROM layer WHERE category IN ('supermarket', 'convenience_store', 'drugstore', 'butcher_shop', 'seafood_market')
      UNION ALL SELECT * FROM gc_uniq UNION ALL SELECT * FROM fresh_uniq""",
    "numbered": "SELECT row_number() OVER () AS rn, * FROM cand WHERE lon IS NOT NULL AND lat IS NOT NULL",
    "spots": "SELECT DISTINCT lon, lat FROM numbered",
    "spot_region": _inside("spots", "region_edges", "p.lon, p.lat"),
    "located": """
      SELECT cat, name, brand, src, r.pref AS prefecture, n.lat, n.lon AS lng
      FROM numbered n JOIN spot_region r ON n.lon = r.lon AND n.lat = r.lat""",
}


def _normal(table: str, source: str, license_: str, rank: int, city_raw: str, srcid: str = "") -> str:
    return f"""
      SELECT 'P1' AS prefecture, 'M1' AS city, '{city_raw}' AS city_raw, {_strip('facility_name')} AS name, '' AS name_kana,
        {_strip('biz')} AS business_type,
        {_strip('addr1')} || CASE WHEN {_strip('addr2')} = '' THEN '' ELSE ' ' || {_strip('addr2')} END AS address,
        {_strip('lat_s')} AS lat, {_strip('lng_s')} AS lng,
        CASE WHEN {_strip('lat_s')} <> '' AND {_strip('lng_s')} <> '' THEN 'source' ELSE '' END AS geocoding_level,
        '' AS phone, {_strip('lic')} AS license_no, {_date('lic_date')} AS license_date, '' AS expire_date,
        '{source}' AS sources, '{license_}' AS licenses, '{srcid or table}' AS srcid, {rank} AS source_rank, row_pos
      FROM {table} WHERE {_strip('facility_name')} <> '' OR {_strip('addr1 || addr2')} <> ''"""


_VALUES = [c for c in vocab.REGISTER_COLUMNS if c not in ("sources", "licenses")]


def _merge(source: str) -> str:
    first = ", ".join(f"max({c}) FILTER (WHERE rn = 1) AS {c}" for c in _VALUES)
    return f"""
      SELECT {first}, string_agg(DISTINCT sources, '; ' ORDER BY sources) AS sources,
        string_agg(DISTINCT licenses, '; ' ORDER BY licenses) AS licenses,
        string_agg(DISTINCT srcid, ',' ORDER BY srcid) AS srcid, count(*) AS n_rows, k
      FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY source_rank, row_pos) AS rn
            FROM (SELECT *, {_squeeze('name')} || '|' || {_squeeze('address')} || '|' || {_squeeze('business_type')} AS k FROM {source}))
      GROUP BY k"""


_CTE |= {
    "norm_a": _normal("reg_a", "Register A", "CC BY 4.0", 0, "M1"),
    "norm_b": _normal("reg_b", "Register B", "PDL 1.0", 1, "M1 raw"),
    "norm": "SELECT * FROM norm_a UNION ALL SELECT * FROM norm_b",
    "merged": _merge("norm"),
    "merged_a": _merge("norm_a"),
    "norm_new": _normal("reg_b", "Register A", "CC BY 4.0", 0, "M1", "reg_a"),
    "merged_new": _merge("norm_new"),
}


_MORTON = " + ".join(f"(((x >> {i}) & 1) << {2 * i}) + (((y >> {i}) & 1) << {2 * i + 1})" for i in range(16))
_CTE |= {
    "delivered": """
      SELECT 'd' || n AS delivery, row_pos, facility_name, addr1, addr2, biz, lat_s, lng_s, lic_date,
        CASE WHEN n >= 3 AND row_pos % 9 = 0 THEN lic || 'x' ELSE lic END AS lic
      FROM reg_a, (SELECT unnest(generate_series(1, 4)) AS n) WHERE (row_pos * n) % 7 <> 3""",
    "state": f"""
      SELECT delivery, {_squeeze('name')} || '|' || {_squeeze('address')} || '|' || {_squeeze('business_type')} AS match_key,
        arg_min(row(license_no, lat, lng, license_date, name, address), row_pos) AS body, CAST(substr(delivery, 2) AS BIGINT) AS seq
      FROM ({_normal('delivered', '', '', 0, 'M1', 'x').replace("AS srcid", "AS srcid, delivery")}) GROUP BY 1, 2""",
    "last_delivery": "SELECT * FROM delivered WHERE delivery = 'd4'",
    "norm_last": _normal("last_delivery", "Register A", "CC BY 4.0", 0, "M1", "reg_a"),
    "merged_last": _merge("norm_last"),
    "varied": """
      SELECT file_no, list_sort(list_distinct(list_filter(['facility_name', 'addr1', 'addr2', 'biz', 'lic', 'lat_s', 'lng_s', 'lic_date'],
          lambda c, i: i - 1 <> file_no % 5) || CASE WHEN file_no % 3 = 0 THEN ['own', 'own ' || CAST(file_no % 4 AS VARCHAR)] ELSE [] END)) AS titles
      FROM (SELECT DISTINCT CAST(floor(c_custkey / 50.0) AS BIGINT) AS file_no FROM customer)""",
    "signed": "SELECT *, sha256(array_to_string(titles, chr(10))) AS signature FROM varied",
    "gazetteer": "SELECT DISTINCT * FROM (" + _plain(views.GAZETTEER) + ")",
    "names": f"""
      SELECT prefix, any_value(prefecture) AS prefecture, any_value(municipality) AS municipality FROM (
        SELECT {_squeeze('prefecture || municipality')} AS prefix, * FROM gazetteer
        UNION ALL SELECT {_squeeze('municipality')}, * FROM gazetteer) GROUP BY prefix HAVING count(*) = 1""",
    "in_town": f"""
      SELECT n.srcid, n.row_pos, n.address, arg_max(g.prefecture, length(g.prefix)) AS found_prefecture, arg_max(g.municipality, length(g.prefix)) AS found_municipality
      FROM norm n LEFT JOIN names g ON {_squeeze('n.address')} LIKE g.prefix || '%' GROUP BY n.srcid, n.row_pos, n.address""",
    "located_a": "SELECT row_pos AS id, facility_name AS name, mx AS lon, my AS lat FROM reg_a JOIN area ON pref = 'area ' || row_pos",
    "located_b": "SELECT row_pos AS id, facility_name AS name, mx + 0.0011::DOUBLE AS lon, my + 0.0011::DOUBLE AS lat FROM reg_b JOIN area ON pref = 'area ' || row_pos",
}


def _with(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    tables = _CTE | (extra or {})
    wanted = names.split() + list(extra or {})
    return "WITH " + ",\n".join(f"{n} AS ({tables[n]})" for n in wanted) + "\n" + body.strip()


_FEATURE = (f"SELECT 'Feature' AS type, 'Point' AS geometry_type, lon, lat, name, {_BUCKET} AS cat, category AS cat_raw, confidence"
            " FROM layer WHERE lon IS NOT NULL AND lat IS NOT NULL")
_TILE = {
    "tiled": f"""
      SELECT id, {_BUCKET} AS cat, confidence, CAST(floor((lon + 180.0) / 360.0 * 4096) AS BIGINT) AS x12,
        CAST(floor((1.0 - ln(tan(radians(lat)) + 1.0 / cos(radians(lat))) / pi()) / 2.0 * 4096) AS BIGINT) AS y12
      FROM layer""",
    "zoomed": """
      SELECT z, x12 // CAST(pow(2, 12 - z) AS BIGINT) AS x, y12 // CAST(pow(2, 12 - z) AS BIGINT) AS y, t.*
      FROM tiled t, (SELECT unnest(generate_series(0, 12)) AS z)""",
}
_CAPTURE = "\nUNION ALL ".join(
    f"SELECT g.chain, {r}.0::DOUBLE AS radius_m, count(*) AS n_generic, count(*) FILTER (WHERE m.d <= {r}) AS n_captured,"
    f" round(count(*) FILTER (WHERE m.d <= {r}) / count(*) * 100, 4) AS capture_pct"
    " FROM shops g LEFT JOIN nearest m ON g.id = m.id WHERE NOT g.branded GROUP BY g.chain"
    for r in (50, 100, 500)
)
_LAYER = "place best layer"
_REGISTERS = "reg_a reg_b norm_a norm_b norm merged"

ORACLES: dict[str, str] = {
    "extract_flatten": _with("place raw_place", f"""
      SELECT id, name, category, replace(alt_csv, ',', '|') AS category_alt, confidence, brand_wikidata, brand_name, operating_status,
        CASE WHEN n_addresses = 2 THEN country END AS country, CASE WHEN n_addresses = 2 THEN region END AS region,
        CASE WHEN n_addresses = 2 THEN locality END AS locality, CASE WHEN n_addresses = 2 THEN address END AS address,
        'Overture|' || provider AS datasets, lon, lat
      FROM raw_place WHERE lon BETWEEN 122.5 AND 154.0 AND lat BETWEEN 24.0 AND 45.8 AND category IN ({_list(vocab.FOOD_CATEGORIES)})"""),
    "chain_classify": _with("place", f"""
      SELECT id, name, {_case('name')} AS chain, {_case('name', f"ELSE '{vocab.OTHER_CHAIN}'")} AS chain_or_other, name LIKE '%店' AS branded FROM place"""),
    "dedup_best_provider": _with(_LAYER, f"SELECT {_LAYER_COLUMNS} FROM layer"),
    "best_provider_by_chain": _with("place", f"""
      SELECT chain, provider, n FROM (
        SELECT chain, provider, n, row_number() OVER (PARTITION BY chain ORDER BY n DESC, provider DESC) AS rn
        FROM (SELECT {_case('name')} AS chain, provider, count(*) AS n FROM place GROUP BY 1, 2) WHERE chain IS NOT NULL)
      WHERE rn = 1"""),
    "provider_composition": _with("place", """
      SELECT provider, count(*) AS n, round(count(*) / (SELECT count(*) FROM place WHERE country = 'JP') * 100, 4) AS share_pct
      FROM place WHERE country = 'JP' GROUP BY provider"""),
    "country_composition": _with("place", "SELECT country, count(*) AS n FROM place GROUP BY country"),
    "inline_dimension": _with("place best", f"""
      SELECT c.chain, best.best_provider AS provider, c.n FROM (SELECT {_case('name')} AS chain, count(*) AS n FROM place GROUP BY 1) c
      LEFT JOIN best ON c.chain = best.chain"""),
    "compare_sources": _with(f"{_LAYER} osm comparison", "SELECT * FROM comparison"),
    "compare_sources_total": _with(f"{_LAYER} osm comparison", """
      SELECT bucket, primary_n, secondary_n, diff FROM comparison
      UNION ALL SELECT 'all', sum(primary_n)::BIGINT, sum(secondary_n)::BIGINT, sum(diff)::BIGINT FROM comparison"""),
    "report_spine": _with(_LAYER, f"""
      SELECT s.ord, s.label, c.category, coalesce(c.n, 0) AS n
      FROM (VALUES {', '.join(f"({i}, '{b}', '{label}')" for i, (b, label) in enumerate(vocab.BUCKETS, 1))}) AS s(ord, bucket, label)
      LEFT JOIN (SELECT {_BUCKET} AS bucket, category, count(*) AS n FROM layer GROUP BY 1, 2) c ON s.bucket = c.bucket"""),
    "coverage_ratio": _with(f"{_LAYER} osm comparison", """
      SELECT c.bucket, o.official::BIGINT AS official, primary_n, secondary_n, round(primary_n / o.official * 100, 4) AS primary_pct,
        round(secondary_n / o.official * 100, 4) AS secondary_pct
      FROM comparison c JOIN (VALUES ('conv', 56352), ('super', 23078), ('drug', 17622)) AS o(bucket, official) ON c.bucket = o.bucket"""),
    "union_inflation": _with("place osm", f"""
      , a AS (SELECT lon, lat FROM place WHERE category = 'convenience_store'),
      b AS (SELECT TRY_CAST(lon_s AS DOUBLE) AS lon, TRY_CAST(lat_s AS DOUBLE) AS lat FROM osm WHERE lower(shop) = 'convenience'),
      n AS (SELECT (SELECT count(*) FROM a) AS n_primary,
                   (SELECT count(*) FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE {_near_deg('b', 'a')})) AS n_added)
      SELECT n_primary, n_added, n_primary + n_added AS n_union, round((n_primary + n_added) / 56352 * 100, 4) AS union_pct FROM n"""),
    "spatial_dup_report": _with("place shops dup", """
      SELECT chain, count(*) FILTER (WHERE branded) AS branded, count(*) FILTER (WHERE NOT branded) AS generic,
        count(*) FILTER (WHERE NOT branded AND d.id IS NOT NULL) AS near_duplicate,
        count(*) FILTER (WHERE NOT branded AND d.id IS NULL) AS isolated,
        count(*) - count(*) FILTER (WHERE NOT branded AND d.id IS NOT NULL) AS rows_after
      FROM shops s LEFT JOIN dup d ON s.id = d.id GROUP BY ROLLUP(chain)"""),
    "spatial_dup_flags": _with("place shops dup", """
      SELECT s.id, chain, branded, coalesce(NOT branded AND d.id IS NOT NULL, false) AS is_duplicate FROM shops s LEFT JOIN dup d ON s.id = d.id"""),
    "capture_rate_by_radius": _with("place shops", f"""
      , nearest AS (SELECT g.id, min({_METRES}) AS d FROM shops g JOIN shops b ON g.chain = b.chain WHERE NOT g.branded AND b.branded GROUP BY g.id)
      {_CAPTURE}"""),
    "nearest_branch": _with("place shops", f"""
      , d AS (SELECT g.id, b.id AS other_id, round({_METRES}, 6) AS d FROM shops g JOIN shops b ON g.chain = b.chain
        WHERE NOT g.branded AND b.branded AND {_METRES} <= 2000)
      SELECT g.id, n.other_id, round(n.d, 3) AS metres FROM shops g LEFT JOIN (
        SELECT id, other_id, d, row_number() OVER (PARTITION BY id ORDER BY d, other_id) AS rn FROM d) n ON g.id = n.id AND n.rn = 1 WHERE NOT g.branded"""),
    "nearest_three_shops": _with("place", f"""
      , d AS (SELECT g.id, b.id AS other_id, round({_METRES}, 6) AS d FROM place g JOIN place b ON abs(g.lat - b.lat) < 0.01
        WHERE g.category = 'supermarket' AND b.category = 'convenience_store' AND {_METRES} <= 1000)
      SELECT g.id, n.nth::INTEGER AS nth, n.other_id, round(n.d, 3) AS metres FROM place g LEFT JOIN (
        SELECT id, other_id, d, row_number() OVER (PARTITION BY id ORDER BY d, other_id) AS nth FROM d) n ON g.id = n.id AND n.nth <= 3
      WHERE g.category = 'supermarket'"""),
    "fuzzy_link": _with("reg_a reg_b area located_a located_b", f"""
      , pairs AS (SELECT g.id, b.id AS other_id, levenshtein(lower({_squeeze('g.name')}), lower({_squeeze('b.name')})) AS edits, round({_METRES}, 3) AS metres
        FROM located_a g JOIN located_b b ON abs(g.lat - b.lat) < 0.2 AND {_METRES} <= 20000 WHERE {_squeeze('g.name')} <> '' AND {_squeeze('b.name')} <> '')
      SELECT id, other_id, edits::INTEGER AS edits, metres FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY edits, metres, other_id) AS rn FROM pairs WHERE edits <= 2) WHERE rn = 1"""),
    "noise_purge": _with("place", f"SELECT id, name FROM place WHERE category = 'grocery_store' AND NOT ({_NOISE})"),
    "spatial_anti_join_grocery": _with("place osm osm_fresh", "SELECT * FROM gc_uniq", _fresh_and_grocery("place")),
    "spatial_anti_join_fresh": _with("place osm osm_fresh", "SELECT * FROM fresh_uniq", _fresh_and_grocery("place")),
    "assign_region_of_place": _with("place region_edges", _inside("place", "region_edges", "p.id")),
    "assign_shop_area": _with("place area area_edges", _inside(
        "place", "area_edges", "p.id", "AND p.lon BETWEEN e.west AND e.east AND p.lat BETWEEN e.south AND e.north")),
    "assign_chain_area": _with("place area area_edges", "SELECT id, 'group ' || CAST(CAST(substr(pref, 6) AS BIGINT) % 20 AS VARCHAR) AS pref FROM (" + _inside(
        "place", "area_edges", "p.id", "AND p.lon BETWEEN e.west AND e.east AND p.lat BETWEEN e.south AND e.north") + ")"),
    "build_master": _with(f"{_LAYER} osm osm_fresh region_edges", """
      SELECT row_number() OVER (ORDER BY cat, src, prefecture, lng, lat, name NULLS FIRST, brand NULLS FIRST) AS store_id,
        cat, name, brand, src, prefecture, lat, lng FROM located""", _MASTER),
    "master_files": _with(f"{_LAYER} osm osm_fresh region_edges", """
      SELECT store_id, cat, src, prefecture, lng AS wkb_lng, lat AS wkb_lat, lng AS csv_lng, lat AS csv_lat
      FROM (SELECT row_number() OVER (ORDER BY cat, src, prefecture, lng, lat, name NULLS FIRST, brand NULLS FIRST) AS store_id, * FROM located)""", _MASTER),
    "master_counts": _with(f"{_LAYER} osm osm_fresh region_edges", f"""
      SELECT cat, CASE cat {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.MASTER_LABELS)} ELSE '{vocab.OTHER_LABEL}' END AS label, count(*) AS n
      FROM located GROUP BY cat""", _MASTER),
    "master_counted": _with(f"{_LAYER} osm osm_fresh region_edges", """
      SELECT cat, count(*) AS n, (SELECT count(*) FROM cand) AS n_candidates, (SELECT count(*) FROM located) AS n_master,
        (SELECT count(*) FROM cand) - (SELECT count(*) FROM located) AS n_dropped FROM located GROUP BY cat""", _MASTER),
    "merge_counted": _with(_REGISTERS, """
      SELECT srcid, count(*) AS n, (SELECT sum(n_rows)::BIGINT FROM merged) AS rows_before, (SELECT count(*) FROM merged) AS rows_after,
        (SELECT sum(n_rows)::BIGINT - count(*) FROM merged) AS rows_removed FROM merged GROUP BY srcid"""),
    "clustered_window": _with("place", "SELECT id, category, lon, lat FROM place WHERE lon BETWEEN 131.0 AND 132.5 AND lat BETWEEN 33.5 AND 34.25"),
    "row_accounting": _with(f"{_LAYER} osm osm_fresh region_edges", """
      SELECT (SELECT count(*) FROM cand) AS n_candidates, (SELECT count(*) FROM located) AS n_master,
        (SELECT count(*) FROM cand) - (SELECT count(*) FROM located) AS n_dropped""", _MASTER),
    "date_normalize": _with("reg_a", f"SELECT row_pos, lic_date AS raw_date, {_date('lic_date')} AS norm_date FROM reg_a"),
    "register_normalize": _with("reg_a reg_b norm_a norm_b norm", "SELECT * FROM norm"),
    "register_merge": _with(_REGISTERS, "SELECT * EXCLUDE (k) FROM merged"),
    "register_order": _with(_REGISTERS, f"""
      SELECT row_number() OVER (ORDER BY first_rank, first_pos) AS "position", name, address, business_type
      FROM merged JOIN (SELECT k, min(source_rank) AS first_rank, arg_min(row_pos, source_rank * 1000000000000 + row_pos) AS first_pos
        FROM (SELECT *, {_squeeze('name')} || '|' || {_squeeze('address')} || '|' || {_squeeze('business_type')} AS k FROM norm) GROUP BY k) USING (k)"""),
    "merge_summary": _with(_REGISTERS, """
      SELECT sum(n_rows)::BIGINT AS rows_before, count(*) AS rows_after, sum(n_rows)::BIGINT - count(*) AS rows_removed FROM merged"""),
    "column_completeness": _with(_REGISTERS, " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {_strip(c)} <> '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 4) AS filled_pct FROM merged"
        for c in vocab.REGISTER_COLUMNS)),
    "source_counts": _with("reg_a reg_b norm_a norm_b norm", """
      SELECT 'P1' AS pref, 'M1' AS muni, CASE srcid WHEN 'reg_a' THEN 'own' ELSE 'shared' END AS route, '✅' AS avail, count(*) AS records,
        max(sources) AS source, max(licenses) AS license, '' AS url FROM norm GROUP BY srcid"""),
    "area_match_rate": _with(_REGISTERS, """
      , area_ref(area, a, b, reference) AS (VALUES ('both', true, true, 1000), ('A', true, false, 1200), ('B', false, true, NULL), ('none', false, false, 10)),
      hits AS (SELECT area, reference::BIGINT AS reference,
        (SELECT count(*) FROM merged WHERE (r.a AND list_contains(string_split(srcid, ','), 'reg_a')) OR (r.b AND list_contains(string_split(srcid, ','), 'reg_b'))) AS n
        FROM area_ref r)
      SELECT area, reference, n, round(n / reference * 100, 4) AS match_pct FROM hits"""),
    "register_diff": _with("reg_a reg_b norm_a norm_new merged_a merged_new", f"""
      SELECT coalesce(o.k, n.k) AS match_key,
        CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS change
      FROM merged_a o FULL OUTER JOIN merged_new n ON o.k = n.k
      WHERE o.k IS NULL OR n.k IS NULL OR {' OR '.join(f'o.{c} <> n.{c}' for c in vocab.REGISTER_COLUMNS)}"""),
    "register_history": _with("reg_a delivered state", """
      , s AS (SELECT *, CASE WHEN lag(seq) OVER k IS NULL THEN 'new' WHEN seq - lag(seq) OVER k > 1 THEN 'returned' WHEN body <> lag(body) OVER k THEN 'changed' END AS opened
        FROM state WINDOW k AS (PARTITION BY match_key ORDER BY seq)),
      r AS (SELECT *, count(opened) OVER (PARTITION BY match_key ORDER BY seq) AS nth FROM s)
      SELECT match_key, nth, min(delivery) AS first_seen, max(delivery) AS last_seen, count(*) AS n_deliveries, max(opened) AS opened, max(seq) = 4 AS open
      FROM r GROUP BY match_key, nth"""),
    "register_refresh": _with("reg_a delivered last_delivery norm_last merged_last", "SELECT * EXCLUDE (k) FROM merged_last"),
    "file_signatures": _with("varied signed", "SELECT 'file-' || file_no AS file, array_to_string(titles, '|') AS titles, signature FROM signed"),
    "near_signatures": _with("varied signed", """
      , u AS (SELECT DISTINCT signature, titles FROM signed)
      SELECT a.signature, b.signature AS other, round(len(list_intersect(a.titles, b.titles)) / len(list_distinct(a.titles || b.titles)), 6) AS jaccard
      FROM u a JOIN u b ON a.signature < b.signature WHERE len(list_intersect(a.titles, b.titles)) / len(list_distinct(a.titles || b.titles)) >= 0.75"""),
    "mapping_proposals": _with("varied", """
      , w(source_id, k, wanted) AS (SELECT 'known-' || k, k, ['facility_name', 'lic', 'own ' || k, 'addr1'] || CASE WHEN k % 2 = 1 THEN ['addr2'] ELSE [] END
        FROM (SELECT unnest(generate_series(0, 3)) AS k)),
      f AS (SELECT file_no, source_id, k, len(list_intersect(titles, wanted)) AS n_found, len(wanted) AS n_wanted FROM varied, w)
      SELECT 'file-' || file_no AS file, source_id, n_found, n_wanted FROM (
        SELECT *, row_number() OVER (PARTITION BY file_no ORDER BY n_found / n_wanted DESC, n_found DESC, k) AS rn FROM f WHERE n_found > 0) WHERE rn = 1"""),
    "municipality_of_address": _with("reg_a reg_b norm_a norm_b norm gazetteer names in_town", "SELECT * FROM in_town"),
    "municipality_coverage": _with("reg_a reg_b norm_a norm_b norm gazetteer names in_town", """
      , t AS (SELECT g.prefecture, g.municipality, count(i.address) AS n FROM gazetteer g LEFT JOIN (
        SELECT * FROM in_town WHERE srcid = 'reg_a' AND address NOT LIKE 'Town 1%') i
        ON g.prefecture = i.found_prefecture AND g.municipality = i.found_municipality GROUP BY g.prefecture, g.municipality)
      SELECT CASE grouping_id(prefecture, municipality) WHEN 3 THEN 'country' WHEN 1 THEN 'prefecture' ELSE 'municipality' END AS level, prefecture, municipality,
        sum(n)::BIGINT AS n_rows, count(*) AS n_municipalities, count(*) FILTER (WHERE n > 0) AS n_covered,
        round(count(*) FILTER (WHERE n > 0) / count(*) * 100, 4) AS covered_pct FROM t GROUP BY ROLLUP (prefecture, municipality)"""),
    "municipality_gaps": _with("reg_a reg_b norm_a norm_b norm gazetteer names in_town", """
      SELECT prefecture, municipality FROM gazetteer WHERE (prefecture, municipality) NOT IN (
        SELECT (found_prefecture, found_municipality) FROM in_town WHERE srcid = 'reg_a' AND address NOT LIKE 'Town 1%' AND found_municipality IS NOT NULL)"""),
    "registry_scan": _with("reg_b norm_b", """
      , f AS (SELECT k || '-' || CAST(floor(row_pos / 500.0) AS BIGINT) AS file, n.* FROM norm_b n, (VALUES ('utf8'), ('sjis'), ('sjis_declared'), ('book')) AS t(k))
      SELECT * EXCLUDE (file, source_rank) REPLACE ('M1' AS city_raw, file AS srcid, 'Register ' || file AS sources, 'CC BY 4.0' AS licenses,
        row_number() OVER (PARTITION BY file ORDER BY row_pos) - 1 AS row_pos) FROM f"""),
    "registry_missing": """
      SELECT DISTINCT k || '-' || CAST(floor(c_custkey / 500.0) AS BIGINT) AS source_id, 'phone' AS target, 'no_such_column' AS "column"
      FROM customer, (VALUES ('utf8'), ('sjis'), ('sjis_declared'), ('book')) AS t(k)""",
    "geojson_features": _with(_LAYER, _FEATURE),
    "poi_card": _with("place", f"""
      SELECT id, {_BUCKET} AS cat, coalesce(nullif(name, ''), '{vocab.NO_NAME}') AS title, coalesce(nullif(category, ''), {_BUCKET}) AS category,
        printf('%.2f', confidence) AS confidence FROM place WHERE {_BUCKET} = 'fresh'"""),
    "tile_index": _with("place", """
      SELECT id, 12 AS z, CAST(floor((lon + 180.0) / 360.0 * 4096) AS BIGINT) AS x,
        CAST(floor((1.0 - ln(tan(radians(lat)) + 1.0 / cos(radians(lat))) / pi()) / 2.0 * 4096) AS BIGINT) AS y FROM place"""),
    "tile_pyramid": _with(_LAYER, "SELECT z, x, y, cat, count(*) AS n FROM zoomed GROUP BY z, x, y, cat", _TILE),
    "tile_thinning": _with(_LAYER, """
      SELECT z, x, y, id, tile_rank FROM (
        SELECT *, row_number() OVER (PARTITION BY z, x, y ORDER BY confidence DESC, id) AS tile_rank FROM zoomed) WHERE tile_rank <= 10""", _TILE),
    "tile_drop_densest": _with(_LAYER, f"""
      , cells AS (SELECT id, CAST(floor((lon + 180.0) / 360.0 * 65536) AS BIGINT) AS x,
          CAST(floor((1.0 - ln(tan(radians(lat)) + 1.0 / cos(radians(lat))) / pi()) / 2.0 * 65536) AS BIGINT) AS y FROM layer),
      curve AS (SELECT id, {_MORTON} AS c FROM cells),
      gaps AS (SELECT id, c - lag(c) OVER (ORDER BY c, id) AS gap FROM curve),
      sparse AS (SELECT id, CASE WHEN gap IS NULL THEN 33 WHEN gap = 0 THEN 0 ELSE length(format('{{:b}}', gap)) END AS s FROM gaps),
      more AS (SELECT z, x, y, s, sum(count(*)) OVER (PARTITION BY z, x, y ORDER BY s DESC) AS more FROM zoomed JOIN sparse USING (id) GROUP BY z, x, y, s),
      t AS (SELECT z, least(33, coalesce(max(s) FILTER (WHERE more > 10) + 1, 0)) AS threshold FROM more GROUP BY z)
      SELECT z, x, y, id FROM zoomed JOIN sparse USING (id) JOIN t USING (z) WHERE s >= threshold""", _TILE),
    "roundtrip_parquet": _with(_LAYER, f"SELECT {_LAYER_COLUMNS} FROM layer"),
    "roundtrip_csv": _with(_REGISTERS, f"SELECT {', '.join(vocab.REGISTER_COLUMNS)} FROM merged"),
    "roundtrip_geojson": _with(_LAYER, _FEATURE),
    "tsv_scan": _with("osm", "SELECT * FROM osm"),
    "tsv_typed": _with("osm", "SELECT name, shop, amenity, TRY_CAST(lon_s AS DOUBLE) AS lon_s, TRY_CAST(lat_s AS DOUBLE) AS lat_s FROM osm"),
    "report_text": _with("place", """
      SELECT category, format('{:,}', n) AS n, CASE WHEN n % 2 = 0 THEN '―' ELSE printf('%.1f%%', pct) END AS pct
      FROM (SELECT category, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 1) AS pct FROM place GROUP BY category)"""),
    "region_edges_scan": _with("area area_edges", "SELECT pref, ax, ay, bx, by_ FROM area_edges"),
}
