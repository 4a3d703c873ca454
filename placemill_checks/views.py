"""Portable SQL for the input views; the same text runs on Spark and on the checking engine.

Names in braces are the test tables. A customer stands for a shop, an order for one provider's record of it.
"""

PLACE = """
SELECT 'p' || CAST(o_orderkey AS VARCHAR(20)) AS id, o_orderkey AS n,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE
    CASE o_custkey % 8 WHEN 0 THEN 'セブン-イレブン' WHEN 1 THEN 'ローソン' WHEN 2 THEN 'ファミリーマート'
      WHEN 3 THEN 'ファミマ' WHEN 4 THEN 'ミニストップ' WHEN 5 THEN 'デイリーヤマザキ' WHEN 6 THEN '個人商店'
      ELSE 'Cafe 雑貨' END
    || CASE WHEN o_orderstatus = 'F' THEN ' ' || CAST(o_custkey AS VARCHAR(20)) || '店' ELSE '' END END AS name,
  CASE (CAST(floor(o_custkey/8.0) AS BIGINT) + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END) % 8
    WHEN 0 THEN 'convenience_store' WHEN 1 THEN 'supermarket' WHEN 2 THEN 'grocery_store' WHEN 3 THEN 'drugstore'
    WHEN 4 THEN 'butcher_shop' WHEN 5 THEN 'seafood_market' WHEN 6 THEN 'farmers_market' ELSE 'pharmacy' END AS category,
  CASE o_orderkey % 6 WHEN 0 THEN 'restaurant' WHEN 1 THEN 'cafe,bakery' WHEN 2 THEN 'shopping' WHEN 3 THEN 'farm'
    WHEN 4 THEN NULL ELSE 'other' END AS alt_csv,
  CAST(o_orderkey % 100 AS DOUBLE)/100.0 AS confidence,
  CASE WHEN o_custkey % 8 < 6 THEN 'Q' || CAST(o_custkey % 8 AS VARCHAR(20)) ELSE NULL END AS brand_wikidata,
  CASE WHEN o_custkey % 8 < 6 THEN 'Brand ' || CAST(o_custkey % 8 AS VARCHAR(20)) ELSE NULL END AS brand_name,
  CASE WHEN o_orderkey % 13 = 0 THEN 'closed' ELSE 'open' END AS operating_status,
  CASE WHEN o_orderkey % 20 = 0 THEN 'KR' WHEN o_orderkey % 53 = 0 THEN NULL ELSE 'JP' END AS country,
  'R' || CAST(o_custkey % 47 AS VARCHAR(20)) AS region, 'Town ' || CAST(o_custkey % 500 AS VARCHAR(20)) AS locality,
  'No. ' || CAST(o_orderkey AS VARCHAR(20)) AS address,
  CASE o_orderkey % 4 WHEN 0 THEN 'meta' WHEN 1 THEN 'Foursquare' WHEN 2 THEN 'AllThePlaces' ELSE 'Microsoft' END AS provider,
  CAST(130.0 + ((o_custkey*7919) % 1499)*0.004 + (o_orderkey % 7)*0.00025 AS DOUBLE) AS lon,
  CAST(33.0 + ((o_custkey*104729) % 1493)*0.003 + (o_orderkey % 5)*0.00020 AS DOUBLE) AS lat
FROM {orders}
"""

# the same records as they come: some outside the window, some of other categories, some without an address
RAW_PLACE = """
SELECT id, name, CASE WHEN n % 9 = 4 THEN 'restaurant' ELSE category END AS category, alt_csv, confidence,
  brand_wikidata, brand_name, operating_status, provider,
  CASE WHEN n % 59 = 0 THEN NULL WHEN country IS NULL THEN 0 ELSE 2 END AS n_addresses,
  country, region, locality, address,
  lon + CASE WHEN n % 10 = 3 THEN 20.0 ELSE 0.0 END AS lon, lat + CASE WHEN n % 10 = 7 THEN 9.0 ELSE 0.0 END AS lat
FROM place
"""

COMMUNITY = """
SELECT CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'Shop ' || CAST(o_custkey AS VARCHAR(20)) END AS name,
  CASE o_orderkey % 9 WHEN 0 THEN 'supermarket' WHEN 1 THEN 'Supermarket' WHEN 2 THEN 'convenience' WHEN 3 THEN 'greengrocer'
    WHEN 4 THEN 'butcher' WHEN 5 THEN 'seafood' WHEN 6 THEN 'chemist' WHEN 7 THEN NULL ELSE 'deli' END AS shop,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Marketplace' WHEN o_orderkey % 4 = 1 THEN 'cafe' ELSE NULL END AS amenity,
  CASE WHEN o_orderkey % 41 = 0 THEN 'n/a' ELSE CAST(CAST(130.0 + ((o_custkey*7919) % 1499)*0.004 + (o_orderkey % 13)*0.00031 AS DECIMAL(12,5)) AS VARCHAR(20)) END AS lon_s,
  CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(CAST(33.0 + ((o_custkey*104729) % 1493)*0.003 + (o_orderkey % 11)*0.00023 AS DECIMAL(12,5)) AS VARCHAR(20)) END AS lat_s
FROM {orders}
"""

REGION_EDGES = """
SELECT pref, CAST(ax AS DOUBLE) AS ax, CAST(ay AS DOUBLE) AS ay, CAST(bx AS DOUBLE) AS bx, CAST(by_ AS DOUBLE) AS by_
FROM (VALUES
  ('W', 129.90013, 32.90017, 132.10013, 32.90017), ('W', 132.10013, 32.90017, 132.10013, 35.10017),
  ('W', 132.10013, 35.10017, 129.90013, 35.10017), ('W', 129.90013, 35.10017, 129.90013, 32.90017),
  ('W', 130.70013, 33.60017, 131.40013, 33.60017), ('W', 131.40013, 33.60017, 131.40013, 34.30017),
  ('W', 131.40013, 34.30017, 130.70013, 34.30017), ('W', 130.70013, 34.30017, 130.70013, 33.60017),
  ('E', 132.20013, 32.90017, 136.10013, 32.90017), ('E', 136.10013, 32.90017, 136.10013, 37.60017),
  ('E', 136.10013, 37.60017, 134.20013, 34.00017), ('E', 134.20013, 34.00017, 132.20013, 37.60017),
  ('E', 132.20013, 37.60017, 132.20013, 32.90017)
) AS t(pref, ax, ay, bx, by_)
"""

# one polygon per customer: a diamond around the shop with a diamond-shaped hole; neighbours overlap
AREA = """
SELECT 'area ' || CAST(c_custkey AS VARCHAR(20)) AS pref,
  CAST(130.00007 + ((c_custkey*7919) % 1499)*0.004 AS DOUBLE) AS mx,
  CAST(33.00007 + ((c_custkey*104729) % 1493)*0.003 AS DOUBLE) AS my,
  CAST(0.01913 + (c_custkey % 5)*0.01 AS DOUBLE) AS half, CAST(0.00083 AS DOUBLE) AS hole
FROM {customer}
"""

_REGISTER = """
SELECT c_custkey AS row_pos, %(name)s AS facility_name, 'Town ' || CAST(c_nationkey AS VARCHAR(20)) AS addr1,
  CASE WHEN c_custkey %% 3 = 0 THEN '' ELSE ' Bldg ' || CAST(c_custkey %% 5 AS VARCHAR(20)) || ' ' END AS addr2,
  c_mktsegment AS biz, 'L' || CAST(c_custkey AS VARCHAR(20)) AS lic,
  CASE WHEN c_custkey %% 6 = 0 THEN '' ELSE '34.5' END AS lat_s, '135.5' AS lng_s,
  CASE c_custkey %% 9
    WHEN 0 THEN CAST(2000 + c_custkey %% 25 AS VARCHAR(20)) || '/' || CAST(1 + c_custkey %% 12 AS VARCHAR(20)) || '/' || CAST(1 + c_custkey %% 28 AS VARCHAR(20))
    WHEN 1 THEN CAST(2000 + c_custkey %% 25 AS VARCHAR(20)) || '-' || CAST(1 + c_custkey %% 12 AS VARCHAR(20)) || '-' || CAST(1 + c_custkey %% 28 AS VARCHAR(20)) || ' 00:00:00'
    WHEN 2 THEN 'R' || CAST(1 + c_custkey %% 6 AS VARCHAR(20)) || '.' || CAST(1 + c_custkey %% 12 AS VARCHAR(20)) || '.' || CAST(1 + c_custkey %% 28 AS VARCHAR(20))
    WHEN 3 THEN CAST(40000 + c_custkey %% 5000 AS VARCHAR(20))
    WHEN 4 THEN '令和' || CAST(1 + c_custkey %% 6 AS VARCHAR(20)) || '年' || CAST(1 + c_custkey %% 12 AS VARCHAR(20)) || '月' || CAST(1 + c_custkey %% 28 AS VARCHAR(20)) || '日'
    WHEN 5 THEN CAST(2000 + c_custkey %% 25 AS VARCHAR(20)) || '年1月2日'
    WHEN 6 THEN ''
    WHEN 7 THEN 'H' || CAST(c_custkey %% 31 AS VARCHAR(20)) || '/' || CAST(1 + c_custkey %% 13 AS VARCHAR(20)) || '/' || CAST(1 + c_custkey %% 31 AS VARCHAR(20))
    ELSE CAST(2000 + c_custkey %% 25 AS VARCHAR(20)) || '/02/' || CAST(27 + c_custkey %% 4 AS VARCHAR(20)) END AS lic_date
FROM {customer}
"""
# A spells names with a space, B mostly with U+3000; four in five of B's shops are those of A
REGISTER_A = _REGISTER % {
    "name": "CASE WHEN c_custkey % 50 = 7 THEN '' ELSE replace(c_name, '#', ' ') END"}
REGISTER_B = _REGISTER % {
    "name": "replace(c_name, '#', CASE WHEN c_custkey % 4 = 1 THEN ' ' ELSE '　' END) || CASE WHEN c_custkey % 5 = 0 THEN ' Annex' ELSE '' END"}

# every nation is a town of its region, and the towns of the registers ("Town 0" to "Town 24") are among a hundred others
GAZETTEER = """
SELECT 'Region ' || CAST(n_regionkey AS VARCHAR(20)) AS prefecture, 'Town ' || CAST(n_nationkey AS VARCHAR(20)) AS municipality FROM {nation}
UNION ALL SELECT 'Region ' || CAST(n_regionkey AS VARCHAR(20)), 'Town ' || CAST(n_nationkey + 25 AS VARCHAR(20)) || ' New' FROM {nation}
UNION ALL SELECT 'Region ' || CAST(n_regionkey AS VARCHAR(20)), 'Town ' || CAST(n_nationkey AS VARCHAR(20)) || ' Bldg ' || CAST(n_regionkey AS VARCHAR(20)) FROM {nation}
UNION ALL SELECT 'Region ' || CAST(n_regionkey AS VARCHAR(20)), 'Old Town' FROM {nation}
"""
