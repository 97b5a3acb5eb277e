"""SQL common table expressions that restate the listing tables for DuckDB.

They are written from the definitions, not derived from the Spark code, and
serve only as the other side of the comparison.
"""

from __future__ import annotations

import re

_DAY = "date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE))"
_SNAP = f"(DATE '2024-01-01' + CAST({_DAY} % 120 AS INTEGER))"

CTES: dict[str, str] = {}

CTES["listings"] = f"""
SELECT
  l.l_orderkey * 10 + l.l_linenumber AS list_id,
  l.l_orderkey * 1000000 + l.l_partkey * 10 + l.l_linenumber AS ad_id,
  l.l_suppkey AS account_id,
  s.s_name AS account_name,
  p.p_name AS subject,
  CASE WHEN s.s_nationkey % 3 = 2 THEN NULL ELSE s.s_nationkey % 3 END AS company_ad,
  CASE WHEN l.l_partkey % 97 = 0 THEN NULL ELSE floor(l.l_extendedprice / 5000) * 5000.0e0 END AS price,
  l.l_quantity AS size,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_linenumber AS DOUBLE) END AS width,
  l.l_quantity / CAST(l.l_linenumber AS DOUBLE) * CASE WHEN l.l_partkey % 7 = 0 THEN 1.25e0 ELSE 1.0e0 END AS length,
  CASE WHEN p.p_type IN ('LARGE','PROMO') THEN NULL ELSE CAST(p.p_size % 6 AS DOUBLE) END AS rooms,
  CASE p.p_type WHEN 'SMALL' THEN 'Căn hộ/Chung cư' WHEN 'MEDIUM' THEN 'Căn hộ/Chung cư' WHEN 'LARGE' THEN 'Đất'
       WHEN 'PROMO' THEN 'Văn phòng, Mặt bằng kinh doanh' ELSE 'Nhà ở' END AS category_name,
  'Region' AS region_name,
  n.n_name AS area_name,
  CASE WHEN l.l_partkey % 53 = 0 THEN NULL
       ELSE 'Phường ' || CAST(l.l_partkey % 3 AS VARCHAR) || CASE WHEN l.l_partkey % 5 = 0 THEN ' (Quận 3 cũ)' ELSE '' END
       END AS ward_name,
  o.o_orderstatus AS street_name,
  CAST(10.7e0 AS DOUBLE) + CAST(l.l_suppkey % 20 AS DOUBLE) / 100 + CAST(l.l_partkey % 3 AS DOUBLE) / 1000 AS latitude,
  CAST(106.6e0 AS DOUBLE) + CAST(l.l_suppkey % 10 AS DOUBLE) / 50 AS longitude,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_partkey % 12 AS DOUBLE) END AS number_of_images,
  CASE WHEN l.l_linestatus = 'F' THEN 'Nội thất đầy đủ' WHEN l.l_linenumber % 2 = 0 THEN 'Bàn giao thô' END AS param_furnishing_sell,
  CASE WHEN l.l_returnflag = 'A' THEN 'Đã có sổ' WHEN l.l_returnflag = 'N' THEN 'Đang chờ sổ'
       WHEN l.l_linenumber % 2 = 0 THEN 'Không có sổ' END AS param_property_legal_document,
  CASE WHEN l.l_partkey % 89 = 0 THEN 'liên hệ' WHEN l.l_partkey % 83 = 0 THEN '1.2.3'
       ELSE CAST(CAST(floor(l.l_extendedprice / l.l_quantity) AS BIGINT) AS VARCHAR) || ',5 triệu/m²' END AS param_price_m2,
  CASE split_part(p.p_name, ' ', 1) WHEN 'red' THEN 'Hẻm xe hơi' WHEN 'hot' THEN 'MẶT TIỀN, Nở hậu'
       WHEN 'old' THEN 'Chưa có thổ cư' WHEN 'cold' THEN 'Mặt tiền, Nhà chưa hoàn công' END AS param_pty_characteristics,
  {_SNAP} AS snapshot_date,
  CAST({_SNAP} - (CAST(l.l_quantity * 3 AS INTEGER) % 130) AS TIMESTAMP) AS crawled_at_ts,
  l.l_shipdate AS list_time
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey
"""

CTES["stations_raw"] = """
SELECT s.s_suppkey * 2 + k.k + 1 AS station_id,
  'L1-' || CAST(s.s_suppkey * 2 + k.k + 1 AS VARCHAR) AS station_code,
  s.s_name || '/' || CAST(k.k AS VARCHAR) AS station_name,
  CASE WHEN s.s_suppkey % 2 = 0 THEN 'Elevated' ELSE 'Underground' END AS station_type,
  'Operating' AS station_status,
  n.n_name AS area_name,
  'Phường ' || CAST(s.s_suppkey % 3 AS VARCHAR) AS ward_name,
  CAST(10.7e0 AS DOUBLE) + CAST(s.s_suppkey % 20 AS DOUBLE) / 100 + CAST(k.k AS DOUBLE) * 0.004e0 AS latitude,
  CAST(106.6e0 AS DOUBLE) + CAST(s.s_suppkey % 10 AS DOUBLE) / 50 + CAST(s.s_suppkey % 4 AS DOUBLE) * 0.003e0 AS longitude,
  CASE (s.s_suppkey * 2 + k.k + 1) % 3 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'FALSE' ELSE '' END AS amenity_atm,
  CASE s.s_suppkey % 4 WHEN 0 THEN '1' WHEN 1 THEN 'False' END AS amenity_elevator
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) k
"""

CTES["trends"] = """
SELECT CAST(ts AS DATE) + CAST(user_id % 3 AS INTEGER) * 31 AS date, 'hcm_real_estate' AS keyword_group,
  CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS bat_dong_san,
  CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS mua_nha,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS can_ho,
  CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS chung_cu,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS dat_nen
FROM events GROUP BY 1
"""

CTES["by_id"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY list_time DESC NULLS LAST, ad_id ASC, account_id ASC) AS rn FROM listings)
WHERE rn = 1
"""
CTES["fingerprinted"] = """
SELECT *, sha256(concat_ws('||', subject, CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR), CAST(size AS VARCHAR),
  CAST(account_id AS VARCHAR))) AS content_fp FROM by_id
"""
CTES["by_content"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY content_fp ORDER BY crawled_at_ts DESC NULLS LAST, ad_id ASC, account_id ASC, list_id ASC) AS rn
  FROM fingerprinted)
WHERE rn = 1
"""
CTES["addressed"] = """
SELECT * FROM by_content WHERE region_name IS NOT NULL AND area_name IS NOT NULL AND street_name IS NOT NULL AND ward_name IS NOT NULL
"""

TYPE_FLAGS = """
CAST(CASE WHEN category_name IN ('Đất', 'Văn phòng, Mặt bằng kinh doanh') THEN 1 ELSE 0 END AS INTEGER) AS is_land,
CAST(CASE WHEN category_name = 'Căn hộ/Chung cư' THEN 1 ELSE 0 END AS INTEGER) AS is_apt,
CAST(CASE WHEN category_name = 'Nhà ở' THEN 1 ELSE 0 END AS INTEGER) AS is_house,
CAST(CASE WHEN category_name IN ('Căn hộ/Chung cư', 'Nhà ở') THEN 1 ELSE 0 END AS INTEGER) AS has_rooms"""
FURNISHING_FLAGS = """
CAST(CASE WHEN param_furnishing_sell IN ('Nội thất cao cấp', 'Nội thất đầy đủ') THEN 1 ELSE 0 END AS INTEGER) AS is_furnishing,
CAST(CASE WHEN param_furnishing_sell IN ('Nội thất cao cấp', 'Nội thất đầy đủ') THEN 0 ELSE 1 END AS INTEGER) AS is_not_furnishing"""
_TEXT = "lower(coalesce(param_pty_characteristics, ''))"
_GOOD = "(" + " OR ".join(
    f"contains({_TEXT}, '{w}')" for w in ("hẻm xe hơi", "nhà nở hậu", "nở hậu", "mặt tiền", "thổ cư toàn bộ")) + ")"
_RISK = "(" + " OR ".join(
    f"contains({_TEXT}, '{w}')" for w in ("đất chưa chuyển thổ", "nhà chưa hoàn công", "nhà dính quy hoạch / lộ giới",
                                         "chưa có thổ cư", "không có thổ cư", "thổ cư 1 phần")) + ")"
TRAIT_FLAGS = f"""
CAST(CASE WHEN {_GOOD} AND NOT {_RISK} THEN 1 ELSE 0 END AS INTEGER) AS good_quality,
CAST(CASE WHEN {_RISK} THEN 1 ELSE 0 END AS INTEGER) AS risk_quality,
CAST(CASE WHEN NOT {_GOOD} AND NOT {_RISK} THEN 1 ELSE 0 END AS INTEGER) AS low_quality"""
ADVERTISER_FLAGS = """
CAST(CASE WHEN company_ad = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_company_ad,
CAST(CASE WHEN company_ad = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_personal_ad"""
LEGAL_FLAGS = """
CAST(CASE WHEN param_property_legal_document IN ('Đã có sổ', 'Sổ hồng riêng') THEN 1 ELSE 0 END AS INTEGER) AS fully_legal,
CAST(CASE WHEN param_property_legal_document IN ('Đang chờ sổ', 'Sổ chung / Công chứng vi bằng', 'Hợp đồng mua bán', 'Hợp đồng đặt cọc')
  THEN 1 ELSE 0 END AS INTEGER) AS semi_legal,
CAST(CASE WHEN param_property_legal_document IS NULL
  OR param_property_legal_document IN ('Không có sổ', 'Giấy tờ viết tay', 'Giấy tờ khác', '1') THEN 1 ELSE 0 END AS INTEGER) AS risk_legal"""
WARD = r"trim(regexp_replace(ward_name, '\s*\(Quận.*?cũ\)', '', 'g'))"
NUMBER = "TRY_CAST(replace(regexp_extract(param_price_m2, '[0-9,.]+', 0), ',', '.') AS DOUBLE)"

CTES["flagged"] = f"""
SELECT * REPLACE (
    coalesce(number_of_images, (SELECT quantile_disc(number_of_images, 0.5) FROM addressed)) AS number_of_images,
    coalesce(rooms, 0.0e0) AS rooms,
    {WARD} AS ward_name,
    {NUMBER} AS param_price_m2),
  {TYPE_FLAGS}, {FURNISHING_FLAGS}, {TRAIT_FLAGS}, {ADVERTISER_FLAGS}, {LEGAL_FLAGS}
FROM addressed
"""
CTES["iqr"] = """
SELECT area_name, quantile_disc(param_price_m2, 0.25) AS q1, quantile_disc(param_price_m2, 0.5) AS median,
  quantile_disc(param_price_m2, 0.75) AS q3, CAST(count(*) AS BIGINT) AS row_count, min(param_price_m2) AS low,
  max(param_price_m2) AS high, avg(param_price_m2) AS mean
FROM flagged WHERE param_price_m2 IS NOT NULL AND area_name IS NOT NULL GROUP BY 1
"""
CTES["priced"] = """
SELECT f.* FROM flagged f LEFT JOIN iqr USING (area_name)
WHERE NOT coalesce(f.param_price_m2 < q1 - 1.5e0 * (q3 - q1) OR f.param_price_m2 > q3 + 1.5e0 * (q3 - q1), FALSE)
"""
CTES["sized"] = """
SELECT * REPLACE (round(size, 2) AS size) FROM priced
WHERE coalesce(CASE WHEN size > 0 THEN abs(width * length - size) / size END, 0) <= 0.10e0
"""
CTES["area_codes"] = """
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT area_name AS label FROM flagged)
WHERE label IS NOT NULL
"""
CTES["ward_codes"] = """
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT ward_name AS label FROM flagged)
WHERE label IS NOT NULL
"""
ONE_HOT = """
CAST(CASE WHEN category_name = 'Căn hộ/Chung cư' THEN 1 ELSE 0 END AS INTEGER) AS cat_can_ho_chung_cu,
CAST(CASE WHEN category_name = 'Nhà ở' THEN 1 ELSE 0 END AS INTEGER) AS cat_nha_o,
CAST(CASE WHEN category_name = 'Văn phòng, Mặt bằng kinh doanh' THEN 1 ELSE 0 END AS INTEGER) AS cat_van_phong_mat_bang_kinh_doanh,
CAST(CASE WHEN category_name = 'Đất' THEN 1 ELSE 0 END AS INTEGER) AS cat_at"""
CTES["silver"] = f"""
SELECT snapshot_date, crawled_at_ts, ad_id, list_id, account_id, account_name, price, size, rooms, category_name, area_name,
  ward_name, street_name, latitude, longitude, number_of_images, param_furnishing_sell, param_property_legal_document,
  param_price_m2, param_pty_characteristics, is_land, is_apt, is_house, has_rooms, is_not_furnishing, is_furnishing,
  good_quality, risk_quality, low_quality, is_company_ad, is_personal_ad, fully_legal, semi_legal, risk_legal,
  coalesce(a.code, -1) AS area_name_encoded, coalesce(w.code, -1) AS ward_name_encoded, content_fp, {ONE_HOT}
FROM (
  SELECT *, row_number() OVER (PARTITION BY round(latitude, 5), round(longitude, 5), price, size
    ORDER BY crawled_at_ts DESC NULLS LAST, ad_id ASC, account_id ASC, list_id ASC) AS rn
  FROM sized) g
LEFT JOIN area_codes a ON a.label = g.area_name
LEFT JOIN ward_codes w ON w.label = g.ward_name
WHERE rn = 1
"""
CTES["stations"] = """
SELECT s.* REPLACE (
    CAST(CASE WHEN amenity_atm IN ('TRUE','true','True','1') THEN 1 WHEN amenity_atm IN ('FALSE','false','False','0') THEN 0 END AS INTEGER) AS amenity_atm,
    CAST(CASE WHEN amenity_elevator IN ('TRUE','true','True','1') THEN 1 WHEN amenity_elevator IN ('FALSE','false','False','0') THEN 0 END AS INTEGER) AS amenity_elevator),
  coalesce(a.code, -1) AS area_name_encoded, coalesce(w.code, -1) AS ward_name_encoded
FROM stations_raw s LEFT JOIN area_codes a ON a.label = s.area_name LEFT JOIN ward_codes w ON w.label = s.ward_name
"""
CTES["dim_time"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_key, d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(week(d) AS INTEGER) AS week,
  CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring' WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2027-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
"""
CTES["dim_location"] = """
SELECT l.*, coalesce(t.location_tier, 'Unknown') AS location_tier FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY area_name NULLS FIRST, ward_name NULLS FIRST, street_name NULLS FIRST,
      latitude NULLS FIRST, longitude NULLS FIRST) AS BIGINT) AS location_key
  FROM (SELECT DISTINCT area_name, ward_name, street_name, latitude, longitude, area_name_encoded, ward_name_encoded
        FROM silver WHERE area_name IS NOT NULL)) l
LEFT JOIN (
  SELECT area_name, CASE WHEN a > m * 1.5e0 THEN 'Premium' WHEN a < m * 0.7e0 THEN 'Developing' ELSE 'Standard' END AS location_tier
  FROM (SELECT area_name, avg(price) AS a FROM silver WHERE price IS NOT NULL GROUP BY 1)
  CROSS JOIN (SELECT quantile_disc(price, 0.5) AS m FROM silver WHERE price IS NOT NULL)) t USING (area_name)
"""
CTES["dim_property"] = """
SELECT *, CAST(row_number() OVER (ORDER BY category_name NULLS FIRST, is_land, is_apt, is_house, rooms NULLS FIRST, has_rooms) AS BIGINT) AS property_key,
  CASE WHEN has_rooms = 0 THEN 'No_Rooms_Land' WHEN rooms IS NULL OR rooms = 0 THEN 'Unknown_Rooms' WHEN rooms > 0 AND rooms < 1 THEN 'Studio'
    WHEN rooms >= 1 AND rooms < 2 THEN '1BR' WHEN rooms >= 2 AND rooms < 3 THEN '2BR' WHEN rooms >= 3 AND rooms < 4 THEN '3BR'
    WHEN rooms >= 4 AND rooms < 5 THEN '4BR' WHEN rooms >= 5 THEN '5BR_Plus' ELSE 'Unknown' END AS rooms_category
FROM (SELECT DISTINCT category_name, is_land, is_apt, is_house, rooms, has_rooms FROM silver WHERE category_name IS NOT NULL)
"""
CTES["seller_volume"] = """
SELECT account_id, CAST(count(*) AS BIGINT) AS listing_count FROM silver WHERE account_id IS NOT NULL GROUP BY 1
"""
CTES["dim_seller"] = """
SELECT s.*, coalesce(CASE WHEN v.listing_count >= (SELECT quantile_disc(listing_count, 0.75) FROM seller_volume) THEN 'High-Volume'
    WHEN v.listing_count >= (SELECT quantile_disc(listing_count, 0.5) FROM seller_volume) THEN 'Medium-Volume' ELSE 'Low-Volume' END, 'Unknown') AS seller_tier
FROM (SELECT account_id, account_name, is_company_ad, is_personal_ad, CAST(row_number() OVER (ORDER BY account_id) AS BIGINT) AS seller_key FROM (
    SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY snapshot_date DESC NULLS LAST, ad_id DESC, list_id DESC) AS rn
    FROM silver WHERE account_id IS NOT NULL) WHERE rn = 1) s
LEFT JOIN seller_volume v USING (account_id)
"""
CTES["dim_metro_station"] = """
SELECT *, CAST(row_number() OVER (ORDER BY station_id) AS BIGINT) AS station_key FROM (
  SELECT DISTINCT station_id, station_code, station_name, station_type, station_status, area_name_encoded, ward_name_encoded,
    area_name, ward_name, latitude, longitude FROM stations WHERE station_id IS NOT NULL)
"""
CTES["dim_search_category"] = """
SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'Căn hộ/Chung cư', 'Căn hộ, Chung cư'), (2, 'Nhà ở', 'Nhà, Nhà ở, Nhà riêng'),
  (3, 'Đất', 'Đất, Đất nền'), (4, 'Bất động sản', 'Tất cả loại hình')) AS t(category_key, category_name, category_description)
"""
CTES["area_stats"] = """
SELECT area_name, category_name, avg(price) AS area_price_avg, stddev_samp(price) AS area_price_std,
  quantile_disc(price, 0.5) AS area_price_median, min(price) AS area_price_min, max(price) AS area_price_max,
  CAST(count(*) AS BIGINT) AS area_popularity
FROM silver WHERE price > 0 GROUP BY 1, 2
"""
LEGAL_RISK = "CASE WHEN fully_legal = 1 THEN 'Low' WHEN semi_legal = 1 THEN 'Medium' WHEN risk_legal = 1 THEN 'High' ELSE 'Unknown' END"
QUALITY_TIER = "CASE WHEN good_quality = 1 THEN 'Good' WHEN low_quality = 1 THEN 'Neutral' WHEN risk_quality = 1 THEN 'Risk' ELSE 'Unknown' END"
QUALITY_SCORE = """least(100.0e0, 0.0e0 + CASE WHEN fully_legal = 1 THEN 35 ELSE 0 END + CASE WHEN semi_legal = 1 THEN 15 ELSE 0 END
  + CASE WHEN good_quality = 1 THEN 30 ELSE 0 END + CASE WHEN number_of_images >= 5 THEN 15 WHEN number_of_images >= 1 THEN 5 ELSE 0 END
  + CASE WHEN is_furnishing = 1 THEN 5 ELSE 0 END)"""
CREDIBILITY = """least(100.0e0, 0.0e0 + CASE WHEN is_company_ad = 1 THEN 30 ELSE 0 END + CASE WHEN good_quality = 1 THEN 25 ELSE 0 END
  + CASE WHEN fully_legal = 1 THEN 25 ELSE 0 END + CASE WHEN number_of_images >= 5 THEN 20 WHEN number_of_images >= 1 THEN 10 ELSE 0 END)"""
RICHNESS = """CAST(CASE WHEN number_of_images IS NULL OR number_of_images = 0 THEN 0 WHEN number_of_images < 1 THEN 1 WHEN number_of_images < 3 THEN 3
  WHEN number_of_images < 5 THEN 5 WHEN number_of_images < 10 THEN 7 ELSE 10 END AS INTEGER)"""
AGE = "CAST(date_diff('day', CAST(crawled_at_ts AS DATE), snapshot_date) AS INTEGER)"
AGE_BUCKET = f"CASE WHEN {AGE} <= 7 THEN 'New (0-7d)' WHEN {AGE} <= 30 THEN 'Active (8-30d)' WHEN {AGE} <= 90 THEN 'Aging (31-90d)' ELSE 'Old (90d+)' END"
SATURATION = """CASE WHEN area_popularity IS NOT NULL AND area_price_std IS NOT NULL AND area_price_avg > 0
  THEN round(least(area_popularity / 100 * 50 + area_price_std / area_price_avg * 50, 100.0e0), 1) END"""
SELLER_TYPE = "CASE WHEN is_company_ad = 1 THEN 'Company' WHEN is_personal_ad = 1 THEN 'Personal' ELSE 'Unknown' END"
DAY_KEY = "CAST(strftime(snapshot_date, '%Y%m%d') AS INTEGER)"
MONTH_KEY = "CAST(strftime(snapshot_date, '%Y%m01') AS INTEGER)"
CTES["with_stats"] = """
SELECT s.*, t.* EXCLUDE (area_name, category_name),
  CASE WHEN price IS NOT NULL THEN round(percent_rank() OVER (PARTITION BY s.area_name, s.category_name ORDER BY price NULLS FIRST) * 100, 1) END AS price_percentile_in_area
FROM silver s LEFT JOIN area_stats t ON s.area_name = t.area_name AND s.category_name = t.category_name
"""
CTES["fact_properties"] = f"""
SELECT location_key, {DAY_KEY} AS time_key, property_key, seller_key, ad_id, list_id, f.account_id, price,
  CASE WHEN size > 0 AND price IS NOT NULL THEN price / size END AS price_per_m2,
  CASE WHEN area_price_std > 0 THEN round((price - area_price_avg) / area_price_std, 2) END AS price_z_score,
  price_percentile_in_area, size, {QUALITY_SCORE} AS quality_score, {LEGAL_RISK} AS legal_risk_level, {QUALITY_TIER} AS property_quality_tier,
  number_of_images, {RICHNESS} AS image_richness_score,
  CAST(CASE WHEN number_of_images > 0 THEN 1 ELSE 0 END AS INTEGER) AS has_images,
  CAST(CASE WHEN number_of_images >= 3 THEN 1 ELSE 0 END AS INTEGER) AS has_multiple_images,
  {AGE} AS listing_age_days, {AGE_BUCKET} AS listing_age_bucket,
  CASE WHEN area_price_avg IS NULL THEN 'Unknown' WHEN area_price_avg > mid.m * 1.5e0 THEN 'Premium' WHEN area_price_avg < mid.m * 0.7e0 THEN 'Developing' ELSE 'Standard' END AS location_tier,
  area_popularity, {SATURATION} AS market_saturation_score, {SELLER_TYPE} AS seller_type, {CREDIBILITY} AS seller_credibility_score,
  CAST(month(snapshot_date) AS INTEGER) AS month_of_year, CAST(dayofweek(snapshot_date) + 1 AS INTEGER) AS day_of_week,
  CAST(CASE WHEN dayofweek(snapshot_date) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  CAST(CASE WHEN month(snapshot_date) IN (6, 7, 8, 11, 12) THEN 1 ELSE 0 END AS INTEGER) AS is_peak_season,
  f.rooms, f.is_company_ad, is_furnishing, is_not_furnishing, fully_legal, semi_legal, risk_legal, good_quality, low_quality, risk_quality,
  f.is_land, f.is_apt, f.is_house, f.category_name, snapshot_date, crawled_at_ts
FROM with_stats f
CROSS JOIN (SELECT coalesce(quantile_disc(area_price_avg, 0.5), 0) AS m FROM with_stats) mid
LEFT JOIN (SELECT location_key, area_name, ward_name, street_name, latitude, longitude FROM dim_location) dl
  ON f.area_name IS NOT DISTINCT FROM dl.area_name AND f.ward_name IS NOT DISTINCT FROM dl.ward_name AND f.street_name IS NOT DISTINCT FROM dl.street_name
  AND f.latitude IS NOT DISTINCT FROM dl.latitude AND f.longitude IS NOT DISTINCT FROM dl.longitude
LEFT JOIN dim_property dp ON f.category_name = dp.category_name AND f.is_land = dp.is_land AND f.is_apt = dp.is_apt AND f.is_house = dp.is_house
  AND f.rooms IS NOT DISTINCT FROM dp.rooms AND f.has_rooms = dp.has_rooms
LEFT JOIN (SELECT account_id, seller_key FROM dim_seller) ds ON f.account_id = ds.account_id
"""
CTES["fact_price_area_time"] = f"""
SELECT l.location_key, p.property_key, f.* FROM (
  SELECT area_name, category_name, {MONTH_KEY} AS time_key, round(avg(price), 0) AS price_avg, round(quantile_disc(price, 0.5), 0) AS price_median,
    round(min(price), 0) AS price_min, round(max(price), 0) AS price_max, CAST(count(*) AS BIGINT) AS listing_count, stddev_samp(price) AS price_std
  FROM silver WHERE price > 0 GROUP BY 1, 2, 3) f
LEFT JOIN (SELECT area_name, min(location_key) AS location_key FROM dim_location GROUP BY 1) l USING (area_name)
LEFT JOIN (SELECT category_name, min(property_key) AS property_key FROM dim_property GROUP BY 1) p USING (category_name)
"""
CTES["fact_seller_time"] = f"""
SELECT ds.seller_key, f.* FROM (
  SELECT account_id, account_name, CASE WHEN is_company_ad = 1 THEN 'Company' ELSE 'Personal' END AS seller_type, {MONTH_KEY} AS time_key,
    CAST(count(*) AS BIGINT) AS listing_count, round(avg(price), 0) AS price_avg, round(quantile_disc(price, 0.5), 0) AS price_median,
    round(avg(number_of_images), 1) AS images_avg, CAST(sum(CASE WHEN fully_legal = 1 THEN 1 ELSE 0 END) AS BIGINT) AS legal_listings_count,
    CAST(sum(CASE WHEN good_quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS quality_listings_count
  FROM silver WHERE account_id IS NOT NULL GROUP BY 1, 2, 3, 4) f
LEFT JOIN (SELECT account_id, seller_key FROM dim_seller) ds USING (account_id)
"""
DISTANCE = """round(sqrt(((s.latitude - m.latitude) * 111000) * ((s.latitude - m.latitude) * 111000)
    + ((s.longitude - m.longitude) * 111000 * cos(s.latitude * (3.14159e0 / 180))) * ((s.longitude - m.longitude) * 111000 * cos(s.latitude * (3.14159e0 / 180)))), 0)"""
PROXIMITY = """CASE WHEN distance_to_metro_m IS NULL THEN 'No_Metro_In_Ward' WHEN distance_to_metro_m < 500 THEN 'Near_Metro'
  WHEN distance_to_metro_m < 1500 THEN 'Close_To_Metro' ELSE 'Far_From_Metro' END"""
CTES["near"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT s.*, m.station_id, m.station_key, {DISTANCE} AS distance_to_metro_m,
    row_number() OVER (PARTITION BY s.ad_id, s.list_id, s.snapshot_date ORDER BY {DISTANCE} ASC NULLS LAST, m.station_id ASC NULLS LAST) AS rn
  FROM silver s LEFT JOIN dim_metro_station m ON s.area_name = m.area_name AND s.ward_name = m.ward_name
  WHERE s.latitude IS NOT NULL AND s.longitude IS NOT NULL AND s.price > 0)
WHERE rn = 1
"""
CTES["fact_metro_analysis"] = f"""
SELECT location_key, property_key, {DAY_KEY} AS time_key, station_key, ad_id, list_id, f.area_name, f.ward_name, f.latitude, f.longitude, price,
  CASE WHEN size > 0 THEN round(price / size, 0) END AS price_per_m2, size, f.category_name, f.rooms, is_company_ad, station_id,
  distance_to_metro_m, {PROXIMITY} AS metro_proximity_category, snapshot_date
FROM near f
LEFT JOIN (SELECT location_key, area_name, ward_name, street_name, latitude, longitude FROM dim_location) dl
  ON f.area_name IS NOT DISTINCT FROM dl.area_name AND f.ward_name IS NOT DISTINCT FROM dl.ward_name AND f.street_name IS NOT DISTINCT FROM dl.street_name
  AND f.latitude IS NOT DISTINCT FROM dl.latitude AND f.longitude IS NOT DISTINCT FROM dl.longitude
LEFT JOIN dim_property dp ON f.category_name = dp.category_name AND f.is_land = dp.is_land AND f.is_apt = dp.is_apt AND f.is_house = dp.is_house
  AND f.rooms IS NOT DISTINCT FROM dp.rooms AND f.has_rooms = dp.has_rooms
"""
CTES["volumes"] = """
SELECT date, 'Căn hộ/Chung cư' AS category_name, chung_cu + can_ho AS search_volume FROM trends UNION ALL
SELECT date, 'Nhà ở', mua_nha FROM trends UNION ALL
SELECT date, 'Đất', dat_nen FROM trends UNION ALL
SELECT date, 'Bất động sản', bat_dong_san FROM trends
"""
CTES["fact_search_trends_monthly"] = """
SELECT t.time_key, c.category_key, year_month, v.category_name, search_volume_sum, search_volume_avg, search_volume_min, search_volume_max
FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS year_month, category_name, CAST(sum(search_volume) AS DOUBLE) AS search_volume_sum,
    round(avg(search_volume), 0) AS search_volume_avg, CAST(min(search_volume) AS DOUBLE) AS search_volume_min, CAST(max(search_volume) AS DOUBLE) AS search_volume_max
  FROM volumes GROUP BY 1, 2) v
LEFT JOIN (SELECT CAST(date_trunc('month', date) AS DATE) AS year_month, min(time_key) AS time_key FROM dim_time GROUP BY 1) t USING (year_month)
LEFT JOIN dim_search_category c USING (category_name)
"""


def _count(condition: str, name: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"


_SUPPLY = """CAST(count(DISTINCT list_id) AS BIGINT) AS listing_count, CAST(count(DISTINCT account_id) AS BIGINT) AS unique_seller_count,
  avg(price) AS price_avg, avg(price_per_m2) AS price_per_m2_avg, avg(size) AS size_avg"""
_TYPES = ", ".join(_count(f"is_{k} = 1", f"{k}_count") for k in ("apt", "house", "land"))
_UNKNOWN = _count("is_apt = 0 AND is_house = 0 AND is_land = 0", "unknown_property_count")


def _ratio(count: str, name: str) -> str:
    return f"CASE WHEN listing_count > 0 THEN CAST({count} AS DOUBLE) / listing_count END AS {name}"


_TYPE_RATIOS = ", ".join(_ratio(f"{k}_count", f"{k}_ratio") for k in ("apt", "house", "land"))


def _dominant(fourth: str | None, label: str) -> str:
    counts = {"Can ho / Chung cu": "apt_count", "Nha o": "house_count", "Dat": "land_count"}
    everything = [*counts.values(), *([fourth] if fourth else [])]
    arms = " ".join(
        "WHEN " + " AND ".join(f"{c} >= {o}" for o in everything if o != c) + f" THEN '{name}'" for name, c in counts.items())
    return f"CASE {arms} ELSE '{label}' END AS dominant_property_type"


def _dominant_ratio(fourth: str | None) -> str:
    everything = ["apt_count", "house_count", "land_count", *([fourth] if fourth else [])]
    return f"CAST(greatest({', '.join(everything)}) AS DOUBLE) / nullif(listing_count, 0) AS dominant_property_ratio"


CTES["vw_market_overview_daily"] = f"""
SELECT snapshot_date, CAST(count(*) AS BIGINT) AS row_count, {_SUPPLY}, {_TYPES}, {_UNKNOWN}
FROM fact_properties WHERE snapshot_date IS NOT NULL GROUP BY 1
"""
CTES["vw_market_overview_daily_analysis"] = f"""
SELECT *, {_TYPE_RATIOS}, {_ratio('unknown_property_count', 'unknown_property_ratio')},
  {_dominant('unknown_property_count', 'Khong xac dinh')}, {_dominant_ratio('unknown_property_count')}
FROM vw_market_overview_daily WHERE listing_count > 0
"""
CTES["vw_market_trend_analysis_base"] = f"""
SELECT snapshot_date, fp.location_key, dl.area_name, dl.ward_name, dl.street_name, CAST(count(*) AS BIGINT) AS row_count, {_SUPPLY}, {_TYPES},
  avg(quality_score) AS quality_score_avg
FROM fact_properties fp LEFT JOIN dim_location dl ON fp.location_key = dl.location_key
WHERE snapshot_date IS NOT NULL GROUP BY 1, 2, 3, 4, 5
"""


def _lagged(column: str, stem: str, growth: bool) -> str:
    before = f"prev_{column}"
    text = f"{column} - {before} AS {stem}_change"
    if growth:
        text += f", CASE WHEN {before} > 0 THEN CAST({column} - {before} AS DOUBLE) / {before} END AS {stem}_growth_rate"
    return text


_LAGS = [("listing_count", "listing", True), ("price_per_m2_avg", "price_per_m2", True), ("unique_seller_count", "seller", True),
         ("apt_count", "apt", False), ("house_count", "house", False), ("land_count", "land", False)]
TREND_TYPE = """CASE WHEN {a} > 0 AND {b} > 0 THEN 'Cung tang - Gia tang' WHEN {a} > 0 AND {b} < 0 THEN 'Cung tang - Gia giam'
  WHEN {a} < 0 AND {b} > 0 THEN 'Cung giam - Gia tang' WHEN {a} < 0 AND {b} < 0 THEN 'Cung giam - Gia giam' ELSE 'Khong ro xu huong' END"""
_TREND = TREND_TYPE.format(a="listing_change", b="price_per_m2_change")
CTES["vw_market_trend_analysis"] = f"""
SELECT *, {_TREND} AS supply_price_trend_type FROM (
  SELECT *, {', '.join(_lagged(*x) for x in _LAGS)} FROM (
    SELECT * EXCLUDE (row_count), {', '.join(f'lag({c}) OVER w AS prev_{c}' for c, _, _ in _LAGS)}
    FROM vw_market_trend_analysis_base WHERE listing_count > 0 WINDOW w AS (PARTITION BY location_key ORDER BY snapshot_date)))
"""
CTES["vw_market_trend_monthly_base"] = f"""
SELECT dt.year AS year_value, dt.month AS month_value, dt.year * 100 + dt.month AS month_key, fp.location_key, dl.area_name, dl.ward_name,
  dl.street_name, fp.property_key, dp.category_name AS property_type, {_SUPPLY}, min(price_per_m2) AS price_per_m2_min,
  max(price_per_m2) AS price_per_m2_max, avg(quality_score) AS quality_score_avg
FROM fact_properties fp LEFT JOIN dim_time dt ON fp.time_key = dt.time_key LEFT JOIN dim_location dl ON fp.location_key = dl.location_key
LEFT JOIN dim_property dp ON fp.property_key = dp.property_key
WHERE fp.time_key IS NOT NULL AND list_id IS NOT NULL AND price_per_m2 > 0 AND dt.year IS NOT NULL AND dl.area_name IS NOT NULL AND dp.category_name IS NOT NULL
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9
"""
_PREV_MONTH = "CAST(CASE WHEN {m} = 1 THEN ({y} - 1) * 100 + 12 ELSE {y} * 100 + {m} - 1 END AS INTEGER)"
_MONTHLY = [("listing_count", "listing", True), ("unique_seller_count", "seller", True), ("price_per_m2_avg", "price_per_m2", True)]
CTES["vw_market_trend_monthly_analysis"] = f"""
SELECT *, {', '.join(_lagged(*x) for x in _MONTHLY)} FROM (
  SELECT c.*, p.listing_count AS prev_listing_count, p.unique_seller_count AS prev_unique_seller_count, p.price_per_m2_avg AS prev_price_per_m2_avg
  FROM vw_market_trend_monthly_base c LEFT JOIN vw_market_trend_monthly_base p
    ON c.location_key = p.location_key AND c.property_key = p.property_key
    AND {_PREV_MONTH.format(y='c.year_value', m='c.month_value')} = p.month_key
  WHERE c.listing_count > 0)
"""
CTES["vw_metro_impact_analysis"] = f"""
SELECT f.metro_proximity_category, CASE f.metro_proximity_category WHEN 'Close_To_Metro' THEN 'Gan metro' WHEN 'No_Metro_In_Ward' THEN 'Khong gan metro'
    ELSE 'Khac' END AS metro_group, f.area_name, f.ward_name, f.station_id, max(m.station_name) AS station_name,
  min(distance_to_metro_m) AS nearest_metro_distance_m, CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT list_id) AS BIGINT) AS listing_count,
  avg(price) AS price_avg, avg(price_per_m2) AS price_per_m2_avg, avg(size) AS size_avg,
  {_count("category_name = 'Căn hộ/Chung cư'", 'apt_count')}, {_count("category_name = 'Nhà ở'", 'house_count')}, {_count("category_name = 'Đất'", 'land_count')},
  {_count("category_name NOT IN ('Căn hộ/Chung cư', 'Nhà ở', 'Đất') OR category_name IS NULL", 'other_property_count')}
FROM fact_metro_analysis f LEFT JOIN dim_metro_station m ON f.station_id = m.station_id
WHERE f.metro_proximity_category IS NOT NULL GROUP BY 1, 2, 3, 4, 5
"""
CTES["vw_metro_impact_analysis_detail"] = f"""
SELECT *, {_TYPE_RATIOS}, {_ratio('other_property_count', 'other_property_ratio')}, {_dominant('other_property_count', 'Khac')}
FROM vw_metro_impact_analysis WHERE listing_count > 0
"""
_AREA_COUNTS = ", ".join(
    _count(f"{flag} = 1", name) for name, flag in {
        "good_quality_count": "good_quality", "risk_quality_count": "risk_quality", "low_quality_count": "low_quality",
        "fully_legal_count": "fully_legal", "risk_legal_count": "risk_legal", "company_seller_count": "is_company_ad"}.items())
_SCORES = """avg(quality_score) AS quality_score_avg, avg(market_saturation_score) AS market_saturation_score_avg,
  avg(seller_credibility_score) AS seller_credibility_score_avg"""
CTES["vw_area_market_analysis_base"] = f"""
SELECT fp.location_key, dl.area_name, dl.ward_name, dl.street_name, dl.location_tier, CAST(count(*) AS BIGINT) AS row_count, {_SUPPLY}, {_SCORES},
  {_TYPES}, {_UNKNOWN}, {_AREA_COUNTS}
FROM fact_properties fp LEFT JOIN dim_location dl ON fp.location_key = dl.location_key
WHERE fp.location_key IS NOT NULL GROUP BY 1, 2, 3, 4, 5
"""
_AREA_RATIOS = ", ".join(
    _ratio(f"{n}_count", f"{n}_ratio")
    for n in ("unknown_property", "good_quality", "risk_quality", "low_quality", "fully_legal", "risk_legal", "company_seller"))
CTES["vw_area_market_analysis"] = f"""
SELECT *, {_TYPE_RATIOS}, {_AREA_RATIOS}, {_dominant('unknown_property_count', 'Khong xac dinh')}, {_dominant_ratio('unknown_property_count')}
FROM vw_area_market_analysis_base WHERE listing_count > 0
"""
_HOT_COUNTS = ", ".join(
    _count(f"{flag} = 1", name) for name, flag in {
        "listings_with_images_count": "has_images", "listings_with_multiple_images_count": "has_multiple_images",
        "fully_legal_count": "fully_legal", "risk_legal_count": "risk_legal", "good_quality_count": "good_quality",
        "risk_quality_count": "risk_quality", "company_seller_listing_count": "is_company_ad"}.items())
CTES["vw_hotspot_monthly_base"] = f"""
SELECT dt.year AS year_value, dt.month AS month_value, dt.year * 100 + dt.month AS month_order,
  CAST(dt.year AS VARCHAR) || '-' || lpad(CAST(dt.month AS VARCHAR), 2, '0') AS month_key, fp.location_key, dl.area_name, dl.ward_name, dl.street_name,
  dl.location_tier, CASE WHEN is_apt = 1 THEN 'Can ho / Chung cu' WHEN is_house = 1 THEN 'Nha o' WHEN is_land = 1 THEN 'Dat' ELSE 'Khong xac dinh' END AS property_type,
  {_SUPPLY}, min(price_per_m2) AS price_per_m2_min, max(price_per_m2) AS price_per_m2_max, {_TYPES}, {_SCORES}, avg(area_popularity) AS area_popularity_avg,
  avg(number_of_images) AS number_of_images_avg, avg(listing_age_days) AS listing_age_days_avg, {_HOT_COUNTS}
FROM fact_properties fp LEFT JOIN dim_location dl ON fp.location_key = dl.location_key LEFT JOIN dim_time dt ON fp.time_key = dt.time_key
WHERE fp.location_key IS NOT NULL AND dl.area_name IS NOT NULL AND dt.year IS NOT NULL AND price_per_m2 IS NOT NULL
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10
"""


def _steps(value: str, steps: list[tuple[float, float]], positive: bool, name: str) -> str:
    arms = " ".join(f"WHEN {value} >= {t} THEN {s}e0" for t, s in steps) + (f" WHEN {value} > 0 THEN 0.4e0" if positive else "")
    return f"CASE {arms} ELSE 0.0e0 END AS {name}"


_HOT = [("listing_count", "listing", True), ("unique_seller_count", "unique_seller", True), ("price_per_m2_avg", "price_per_m2", True)]
STEP_SCORES = ", ".join([
    _steps("listing_count", [(30, 1.0), (15, 0.8), (8, 0.6), (3, 0.4)], False, "listing_volume_score"),
    _steps("listing_growth_rate", [(0.5, 1.0), (0.3, 0.8), (0.1, 0.6)], True, "listing_growth_score"),
    _steps("price_per_m2_growth_rate", [(0.3, 1.0), (0.15, 0.8), (0.05, 0.6)], True, "price_growth_score"),
    _steps("unique_seller_count", [(15, 1.0), (8, 0.8), (4, 0.6), (2, 0.4)], False, "seller_score"),
    _steps("quality_score_avg", [(80, 1.0), (60, 0.8), (40, 0.6)], True, "quality_score_norm")])
CTES["vw_hotspot_analysis"] = f"""
SELECT *, {_TREND} AS supply_price_trend_type,
  CASE WHEN hotspot_score >= 0.75e0 AND listing_count >= 5 AND listing_growth_rate > 0 AND price_per_m2_growth_rate > 0 THEN 'High'
    WHEN hotspot_score >= 0.50e0 AND listing_count >= 3 THEN 'Medium' ELSE 'Low' END AS hotspot_level,
  CAST(CASE WHEN listing_growth_rate > 0 AND price_per_m2_growth_rate > 0 THEN 1 ELSE 0 END AS INTEGER) AS is_supply_and_price_increase,
  CAST(CASE WHEN listing_count >= 5 AND listing_growth_rate > 0 AND price_per_m2_growth_rate > 0 AND unique_seller_count >= 3 THEN 1 ELSE 0 END AS INTEGER) AS is_potential_hotspot,
  CAST(CASE WHEN listing_count >= 5 THEN 1 ELSE 0 END AS INTEGER) AS has_high_listing_volume,
  CAST(CASE WHEN listing_growth_rate > 0 THEN 1 ELSE 0 END AS INTEGER) AS has_listing_growth,
  CAST(CASE WHEN price_per_m2_growth_rate > 0 THEN 1 ELSE 0 END AS INTEGER) AS has_price_growth,
  CAST(CASE WHEN unique_seller_growth_rate > 0 THEN 1 ELSE 0 END AS INTEGER) AS has_seller_growth
FROM (SELECT *, listing_volume_score * 0.25e0 + listing_growth_score * 0.25e0 + price_growth_score * 0.20e0 + seller_score * 0.20e0 + quality_score_norm * 0.10e0 AS hotspot_score
  FROM (SELECT *, {STEP_SCORES} FROM (
    SELECT * EXCLUDE (listings_with_images_count, listings_with_multiple_images_count, fully_legal_count, risk_legal_count, good_quality_count, risk_quality_count, company_seller_listing_count),
      {', '.join(_lagged(*x) for x in _HOT)}, {_TYPE_RATIOS}, {_dominant(None, 'Khong xac dinh')}, {_dominant_ratio(None)},
      {', '.join(_ratio(f'{n}_count', f'{n}_ratio') for n in ('fully_legal', 'risk_legal', 'good_quality', 'risk_quality'))},
      {_ratio('company_seller_listing_count', 'company_seller_ratio')}
    FROM (SELECT c.*, p.listing_count AS prev_listing_count, p.unique_seller_count AS prev_unique_seller_count, p.price_per_m2_avg AS prev_price_per_m2_avg
      FROM vw_hotspot_monthly_base c LEFT JOIN vw_hotspot_monthly_base p ON c.location_key = p.location_key AND c.property_type = p.property_type
        AND {_PREV_MONTH.format(y='c.year_value', m='c.month_value')} = p.month_order
      WHERE c.listing_count >= 3))))
"""


def _place_days() -> str:
    counts = ", ".join(_count(f"is_{k} = 1", f"{k}_count") for k in ("apt", "house", "land"))
    flags = {"fully_legal": "fully_legal", "risk_legal": "risk_legal", "good_quality": "good_quality", "risk_quality": "risk_quality", "company_seller": "is_company_ad"}
    ratios = ", ".join(
        f"CAST(sum(CASE WHEN {f} = 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(DISTINCT list_id) AS {n}_ratio" for n, f in flags.items())
    return f"""
SELECT fp.snapshot_date, dl.area_name, dl.ward_name, dl.street_name, max(dl.area_name_encoded) AS area_name_encoded, max(dl.ward_name_encoded) AS ward_name_encoded,
  max(dl.location_tier) AS location_tier, CAST(count(DISTINCT list_id) AS BIGINT) AS listing_count, CAST(count(DISTINCT account_id) AS BIGINT) AS unique_seller_count,
  avg(price) AS price_avg, avg(price_per_m2) AS price_per_m2_avg, avg(size) AS size_avg, {_SCORES}, avg(area_popularity) AS area_popularity_avg,
  avg(listing_age_days) AS listing_age_days_avg, avg(latitude) AS latitude, avg(longitude) AS longitude, {counts}, {ratios}
FROM fact_properties fp JOIN dim_location dl ON fp.location_key = dl.location_key WHERE fp.snapshot_date IS NOT NULL GROUP BY 1, 2, 3, 4"""


CTES["place_days"] = _place_days()
CTES["vw_ml_hotspot_dataset"] = f"""
SELECT *, CASE WHEN target_next_listing_count / listing_count_rolling_avg_7 >= 1.5e0 THEN 'High'
    WHEN target_next_listing_count / listing_count_rolling_avg_7 >= 1.0e0 THEN 'Medium'
    WHEN target_next_listing_count IS NOT NULL THEN 'Low' END AS target_hotspot_level
FROM (SELECT d.*, m.nearest_metro_distance_m, s.search_volume_avg, CAST(year(d.snapshot_date) AS INTEGER) AS year_value, CAST(month(d.snapshot_date) AS INTEGER) AS month_value,
    CAST(quarter(d.snapshot_date) AS INTEGER) AS quarter_value, CAST(week(d.snapshot_date) AS INTEGER) AS week_value, CAST(dayofweek(d.snapshot_date) + 1 AS INTEGER) AS day_of_week,
    CAST(CASE WHEN dayofweek(d.snapshot_date) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    CASE WHEN month(d.snapshot_date) IN (12, 1, 2) THEN 'Winter' WHEN month(d.snapshot_date) IN (3, 4, 5) THEN 'Spring'
      WHEN month(d.snapshot_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
    CASE WHEN nearest_metro_distance_m IS NULL THEN 'No_Metro_In_Ward' WHEN nearest_metro_distance_m < 500 THEN 'Near_Metro'
      WHEN nearest_metro_distance_m < 1500 THEN 'Close_To_Metro' ELSE 'Far_From_Metro' END AS metro_proximity_category,
    CASE WHEN nearest_metro_distance_m IS NULL THEN 0.0e0 WHEN nearest_metro_distance_m < 500 THEN 1.0e0
      WHEN nearest_metro_distance_m < 1500 THEN 0.6e0 ELSE 0.2e0 END AS metro_proximity_score,
    lag(listing_count, 1) OVER w AS listing_count_lag_1, lag(listing_count, 2) OVER w AS listing_count_lag_2, lag(listing_count, 3) OVER w AS listing_count_lag_3,
    avg(listing_count) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS listing_count_rolling_avg_3,
    avg(listing_count) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS listing_count_rolling_avg_7,
    max(listing_count) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS listing_count_rolling_max_7,
    min(listing_count) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS listing_count_rolling_min_7,
    listing_count - lag(listing_count, 1) OVER w AS listing_count_change_from_lag_1,
    listing_count / avg(listing_count) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS listing_count_vs_rolling_avg_7,
    lag(price_per_m2_avg) OVER w AS price_per_m2_lag_1, avg(price_per_m2_avg) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS price_per_m2_rolling_avg_7,
    price_per_m2_avg - lag(price_per_m2_avg) OVER w AS price_per_m2_change_from_lag_1,
    lag(unique_seller_count) OVER w AS unique_seller_count_lag_1, avg(unique_seller_count) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS unique_seller_count_rolling_avg_7,
    lag(market_saturation_score_avg) OVER w AS market_saturation_score_lag_1,
    avg(market_saturation_score_avg) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS market_saturation_score_rolling_avg_7,
    lead(listing_count) OVER w AS target_next_listing_count
  FROM place_days d
  LEFT JOIN (SELECT f.snapshot_date, dl.area_name, dl.ward_name, dl.street_name, min(distance_to_metro_m) AS nearest_metro_distance_m
    FROM fact_metro_analysis f JOIN dim_location dl ON f.location_key = dl.location_key GROUP BY 1, 2, 3, 4) m
    ON d.snapshot_date = m.snapshot_date AND d.area_name = m.area_name AND d.ward_name = m.ward_name AND d.street_name = m.street_name
  LEFT JOIN (SELECT time_key, search_volume_avg FROM fact_search_trends_monthly WHERE category_name = 'Bất động sản') s
    ON CAST(strftime(d.snapshot_date, '%Y%m01') AS INTEGER) = s.time_key
  WINDOW w AS (PARTITION BY d.area_name, d.ward_name, d.street_name ORDER BY d.snapshot_date))
"""

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the expressions it needs, in definition order.

    Each expression is materialised so that views over views are not inlined
    many times over.
    """
    order = list(CTES)
    wanted: set[str] = set()
    pending = [body]
    while pending:
        for word in set(_WORD.findall(pending.pop())):
            if word in CTES and word not in wanted:
                wanted.add(word)
                pending.append(CTES[word])
    if not wanted:
        return body
    parts = [f"{name} AS MATERIALIZED ({CTES[name].strip()})" for name in order if name in wanted]
    return "WITH " + ",\n".join(parts) + "\n" + body
