"""Independent SQL (DuckDB dialect) for the bound layers.

``BASE`` holds one CTE per layer; ``sql(final)`` prefixes a final SELECT with
all of them (DuckDB only evaluates the ones referenced). Conventions shared
with the Spark side:

* dedup picks the first row by every non-key column ascending, NULLs last;
* means are decimal sums (nine places) over the non-NULL count;
* DuckDB integer results are cast to the Spark types (INTEGER, BIGINT).
"""

from __future__ import annotations

_GRAIN = "week_start, species_code, species_name, area_code, area_name"


def _mean(col: str) -> str:
    return f"CAST(sum(CAST({col} AS DECIMAL(38,9))) AS DOUBLE) / CAST(nullif(count({col}), 0) AS DOUBLE)"


def _vessel_rows(build_year: str, power: str, year: int) -> str:
    length = "CAST(10 + s.s_suppkey % 30 AS DOUBLE)"
    return f"""
    SELECT CAST(s.s_suppkey AS VARCHAR) AS vessel_id,
           'R-' || CAST(s.s_suppkey AS VARCHAR) AS registration,
           s.s_name AS vessel_name,
           n.n_name AS vessel_type,
           CASE WHEN {length} <= 20 THEN 'Kyst' WHEN {length} <= 30 THEN 'Kyst større'
                WHEN {length} IS NOT NULL THEN 'Hav' END AS vessel_group,
           {length} AS length_m,
           CAST(CAST(floor({length} / 5) * 5 AS INTEGER) AS VARCHAR) || 'm+' AS length_group,
           {length} / 4.0 AS width_m,
           CAST(s.s_nationkey * 10 AS DOUBLE) AS gross_tonnage,
           CAST({build_year} AS INTEGER) AS build_year,
           {power} AS power_kw,
           n.n_name AS home_municipality,
           r.r_name AS nationality,
           {year} AS register_year
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
                    JOIN region r ON n.n_regionkey = r.r_regionkey"""


_YEAR = "(1960 + s.s_suppkey % 60)"
_OLDER_YEAR = (f"CASE WHEN s.s_suppkey % 4 = 0 THEN NULL WHEN s.s_suppkey % 4 = 1 THEN {_YEAR} "
               f"ELSE {_YEAR} - 1 END")

BASE: dict[str, str] = {
    "landings": """
    SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS note_id,
           CAST(l.l_shipdate AS DATE) AS landing_date,
           CASE WHEN l.l_tax = CAST(0.08 AS DOUBLE) THEN NULL ELSE CAST(l.l_suppkey AS VARCHAR) END AS vessel_id,
           p.p_type AS species_code,
           lower(p.p_type) AS species_name,
           CAST(n.n_regionkey AS VARCHAR) AS area_code,
           r.r_name AS area_name,
           l.l_returnflag AS gear_code,
           CASE WHEN l.l_discount = CAST(0.0 AS DOUBLE) THEN NULL ELSE l.l_quantity END AS weight_kg
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                    JOIN supplier s ON l.l_suppkey = s.s_suppkey
                    JOIN nation n ON s.s_nationkey = n.n_nationkey
                    JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "notes_dedup": """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY note_id ORDER BY
          landing_date ASC NULLS LAST, vessel_id ASC NULLS LAST, species_code ASC NULLS LAST,
          species_name ASC NULLS LAST, area_code ASC NULLS LAST, area_name ASC NULLS LAST,
          gear_code ASC NULLS LAST, weight_kg ASC NULLS LAST) AS rn
      FROM landings) WHERE rn = 1""",
    "silver_landings": """
    SELECT note_id, landing_date, vessel_id, species_code, species_name,
           lpad(area_code, 2, '0') AS area_code, area_name, gear_code, weight_kg
    FROM notes_dedup
    WHERE weight_kg > 0 AND landing_date IS NOT NULL AND vessel_id IS NOT NULL
      AND species_code IS NOT NULL AND lpad(area_code, 2, '0') IS NOT NULL""",
    "vessels_raw": _vessel_rows(_YEAR, "s.s_acctbal", 2025) + "\n    UNION ALL"
    + _vessel_rows(_OLDER_YEAR, "s.s_acctbal + 1.0", 2024),
    "silver_vessels": """
    SELECT * EXCLUDE (rn, register_year) FROM (
      SELECT *, row_number() OVER (PARTITION BY vessel_id ORDER BY build_year DESC NULLS LAST,
          registration ASC NULLS LAST, vessel_name ASC NULLS LAST, vessel_type ASC NULLS LAST,
          vessel_group ASC NULLS LAST, length_m ASC NULLS LAST, length_group ASC NULLS LAST,
          width_m ASC NULLS LAST, gross_tonnage ASC NULLS LAST, power_kw ASC NULLS LAST,
          home_municipality ASC NULLS LAST, nationality ASC NULLS LAST) AS rn
      FROM vessels_raw WHERE vessel_id IS NOT NULL) WHERE rn = 1""",
    "sea_raw": """
    SELECT CAST(o.o_orderdate AS DATE) AS date,
           CAST(n.n_regionkey AS VARCHAR) AS area_code,
           r.r_name AS area_name,
           c.c_acctbal AS sea_temp_c,
           o.o_totalprice AS wave_height_m,
           CAST(o.o_custkey AS DOUBLE) AS current_speed_ms
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                  JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "silver_sea": """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY date, area_code ORDER BY
          area_name ASC NULLS LAST, sea_temp_c ASC NULLS LAST, wave_height_m ASC NULLS LAST,
          current_speed_ms ASC NULLS LAST) AS rn
      FROM (SELECT date, lpad(area_code, 2, '0') AS area_code, area_name, sea_temp_c,
                   wave_height_m, current_speed_ms FROM sea_raw)
      WHERE date IS NOT NULL AND area_code IS NOT NULL) WHERE rn = 1""",
    # Easter by Gauss's rule with its two exceptions (the Spark side uses another method).
    "easter": """
    SELECT y, CAST(make_date(y, 3, 22) + CAST(CASE WHEN d = 29 AND e = 6 THEN 28 WHEN d = 28 AND e = 6 AND (11 * m + 11) % 30 < 19 THEN 27 ELSE d + e END AS INTEGER) AS DATE) AS easter
    FROM (SELECT *, (2 * (y % 4) + 4 * (y % 7) + 6 * d + n) % 7 AS e
          FROM (SELECT *, (19 * (y % 19) + m) % 30 AS d
                FROM (SELECT y, (15 - (13 + 8 * (y // 100)) // 25 + y // 100 - y // 400) % 30 AS m, (4 + y // 100 - y // 400) % 7 AS n
                      FROM (SELECT CAST(unnest(generate_series(1900, 2199)) AS INTEGER) AS y))))""",
    "calendar": """
    SELECT d AS date,
           CAST(date_trunc('week', d) AS DATE) AS week_start,
           CAST(year(d) AS INTEGER) AS year,
           CAST(month(d) AS INTEGER) AS month,
           CAST(weekofyear(d) AS INTEGER) AS iso_week,
           CAST(isodow(d) AS INTEGER) AS weekday,
           isodow(d) >= 6 AS is_weekend,
           strftime(d, '%m-%d') IN ('01-01', '05-01', '05-17', '12-25', '12-26')
             OR date_diff('day', (SELECT easter FROM easter WHERE y = year(d)), CAST(d AS DATE)) IN (-3, -2, 1, 39, 50) AS is_holiday,
           CASE WHEN month(d) IN (12, 1, 2) THEN 'vinter' WHEN month(d) IN (3, 4, 5) THEN 'vaar'
                WHEN month(d) IN (6, 7, 8) THEN 'sommer' ELSE 'hoest' END AS season
    FROM (SELECT CAST(unnest(generate_series(date_trunc('week', min(t)), date_trunc('week', max(t)) + INTERVAL 6 DAY, INTERVAL 1 DAY)) AS DATE) AS d
          FROM (SELECT l_shipdate AS t FROM lineitem UNION ALL SELECT o_orderdate FROM orders))""",
    "lv": """
    SELECT l.*, v.length_m, v.power_kw, CAST(date_trunc('week', l.landing_date) AS DATE) AS week_start
    FROM silver_landings l LEFT JOIN (SELECT vessel_id, length_m, power_kw FROM silver_vessels) v
      ON l.vessel_id = v.vessel_id""",
    "week_volume": f"""
    SELECT {_GRAIN}, sum(weight_kg) AS landed_kg, CAST(count(DISTINCT note_id) AS BIGINT) AS n_notes
    FROM lv GROUP BY {_GRAIN}""",
    "week_fleet": f"""
    SELECT {_GRAIN}, CAST(count(DISTINCT vessel_id) AS BIGINT) AS active_vessels,
           {_mean('length_m')} AS avg_length_m,
           {_mean('power_kw')} AS avg_power_kw
    FROM (SELECT DISTINCT {_GRAIN}, vessel_id, length_m, power_kw FROM lv)
    GROUP BY {_GRAIN}""",
    "week_sea": f"""
    SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, area_code,
           {_mean('sea_temp_c')} AS sea_temp_c,
           {_mean('wave_height_m')} AS wave_height_m,
           {_mean('current_speed_ms')} AS current_speed_ms
    FROM silver_sea GROUP BY 1, 2""",
    "week_calendar": """
    SELECT DISTINCT week_start, iso_week, month, season FROM calendar WHERE weekday = 1""",
    "mart": f"""
    SELECT vo.week_start, vo.species_code, vo.species_name, vo.area_code, vo.area_name,
           vo.landed_kg, vo.n_notes, f.active_vessels, f.avg_length_m, f.avg_power_kw,
           s.sea_temp_c, s.wave_height_m, s.current_speed_ms,
           c.iso_week, c.month, c.season,
           CASE vo.species_code WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 99 END
             AS species_id,
           TRY_CAST(vo.area_code AS INTEGER) AS area_id
    FROM week_volume vo
    LEFT JOIN week_fleet f ON vo.week_start = f.week_start AND vo.species_code = f.species_code
         AND vo.species_name = f.species_name AND vo.area_code = f.area_code AND vo.area_name = f.area_name
    LEFT JOIN week_sea s ON vo.week_start = s.week_start AND vo.area_code = s.area_code
    LEFT JOIN week_calendar c ON vo.week_start = c.week_start""",
    "features": """
    SELECT *,
           sin(2 * pi() * iso_week / 52.0) AS week_sin,
           cos(2 * pi() * iso_week / 52.0) AS week_cos,
           CAST(week_start + INTERVAL 7 DAY AS DATE) AS target_week,
           CAST(year(week_start + INTERVAL 7 DAY) AS INTEGER) AS target_year,
           CAST(month(week_start + INTERVAL 7 DAY) AS INTEGER) AS target_month
    FROM (SELECT *,
           lag(landed_kg, 1) OVER w AS lag_1,
           lag(landed_kg, 4) OVER w AS lag_4,
           avg(landed_kg) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS mean_4,
           lead(landed_kg, 1) OVER w AS target_kg
          FROM mart WINDOW w AS (PARTITION BY species_code, area_code ORDER BY week_start))""",
    "trend": """
    SELECT *, coalesce(lag(landed_kg, 8) OVER w, mean_8) AS lag_8
    FROM (SELECT *, avg(landed_kg) OVER (PARTITION BY species_code, area_code ORDER BY week_start
                                         ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS mean_8
          FROM features)
    WINDOW w AS (PARTITION BY species_code, area_code ORDER BY week_start)""",
    "model_rows": """
    SELECT * FROM trend
    WHERE area_id IS NOT NULL AND iso_week IS NOT NULL AND week_sin IS NOT NULL
      AND week_cos IS NOT NULL AND landed_kg IS NOT NULL AND lag_1 IS NOT NULL
      AND lag_4 IS NOT NULL AND mean_4 IS NOT NULL AND lag_8 IS NOT NULL AND mean_8 IS NOT NULL
      AND n_notes IS NOT NULL AND active_vessels IS NOT NULL AND avg_length_m IS NOT NULL
      AND avg_power_kw IS NOT NULL AND sea_temp_c IS NOT NULL AND wave_height_m IS NOT NULL
      AND current_speed_ms IS NOT NULL AND target_kg IS NOT NULL""",
    "pred": """
    SELECT week_start, target_week, species_code, species_name, area_code, area_name, target_kg,
           round(mean_4, 3) AS predicted_kg, abs(target_kg - round(mean_4, 3)) AS abs_error_kg
    FROM model_rows WHERE target_year = 2001 AND target_month = 7""",
    "history": """
    SELECT week_start, species_code, species_name, area_code, area_name, landed_kg, n_notes,
           active_vessels, sea_temp_c, wave_height_m, current_speed_ms FROM mart""",
    "series": """
    SELECT target_week AS week_start, species_name, area_name, 'Faktisk' AS series, target_kg AS kg
    FROM pred
    UNION ALL
    SELECT target_week AS week_start, species_name, area_name, 'Predikert' AS series,
           predicted_kg AS kg FROM pred""",
}


# The five primes of the public 64-bit xxHash, and Spark's seed.
_P1, _P2, _P3, _P4, _P5 = (f"{p}::UHUGEINT" for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_SEED, _WORD = 42, f"{2 ** 64}::UHUGEINT"


def xxhash64(text: str) -> str:
    """The xxHash64 of a text of fewer than 32 bytes as DuckDB computes it in wide
    integers modulo 2^64; equal to Spark's. ``text`` is a column name."""
    def rotated(x: str, bits: int) -> str:
        return f"list_transform([{x}], lambda x: (x * {2 ** bits}) % {_WORD} + x // {2 ** (64 - bits)})[1]"

    def little(part: str) -> str:
        return f"list_reduce(list_reverse({part}), lambda u, v: u * 256 + v)"

    # The text's bytes; then its 8-byte words, a 4-byte word and single bytes, marked by how many 2^64 are added.
    raw = f"list_transform(range(0, strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::UBIGINT::UHUGEINT)"
    steps = (f"list_transform(range(0, len(b) // 8), lambda w: {little('b[8 * w + 1:8 * w + 8]')}) || "
             f"CASE WHEN len(b) % 8 >= 4 THEN [{_WORD} + {little('b[len(b) // 8 * 8 + 1:len(b) // 8 * 8 + 4]')}] ELSE [] END || "
             f"list_transform(b[len(b) // 4 * 4 + 1:len(b)], lambda t: 2 * {_WORD} + t)")
    whole = f"({rotated(f'xor(h, ({rotated(f'(s * {_P2}) % {_WORD}', 31)} * {_P1}) % {_WORD})', 27)} * {_P1} + {_P4}) % {_WORD}"
    half = f"({rotated(f'xor(h, ((s % {_WORD}) * {_P1}) % {_WORD})', 23)} * {_P2} + {_P3}) % {_WORD}"
    single = f"({rotated(f'xor(h, ((s % {_WORD}) * {_P5}) % {_WORD})', 11)} * {_P1}) % {_WORD}"
    mixed = (f"list_transform([{raw}], lambda b: list_reduce([({_SEED} + {_P5} + len(b)::UHUGEINT) % {_WORD}] || {steps}, "
             f"lambda h, s: CASE WHEN s < {_WORD} THEN {whole} WHEN s < 2 * {_WORD} THEN {half} ELSE {single} END))[1]")
    for bits, prime in ((33, _P2), (29, _P3), (32, "1::UHUGEINT")):
        mixed = f"list_transform([{mixed}], lambda m: (xor(m, m // {2 ** bits}) * {prime}) % {_WORD})[1]"
    return f"list_transform([{mixed}], lambda m: CASE WHEN m >= {2 ** 63} THEN (m::HUGEINT - {2 ** 64}::HUGEINT)::BIGINT ELSE m::BIGINT END)[1]"


def hashed(table: str, column: str, key: str) -> str:
    """A table of the distinct values of a column with their hash keys."""
    return f"(SELECT {column}, {xxhash64(column)} AS {key} FROM (SELECT DISTINCT {column} FROM {table} WHERE {column} IS NOT NULL))"


def sql(final: str) -> str:
    ctes = ",\n".join(f"{name} AS ({body}\n)" for name, body in BASE.items())
    return f"WITH {ctes}\n{final}"
