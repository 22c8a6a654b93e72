"""DuckDB SQL equivalents of the catalogue queries (the correctness oracle).

The buyer fixture and the cleaned buyer table are spelled out as CTEs with the
hash draws expanded for DuckDB (``'0x' || hex`` cast instead of ``conv``).
"""

from __future__ import annotations


def h32(salt: str, key: str = "c_custkey") -> str:
    return f"cast('0x' || substr(md5('{salt}:' || cast({key} AS varchar)), 1, 8) AS bigint)"


def u(salt: str, key: str = "c_custkey") -> str:
    return f"({h32(salt, key)} / 4294967296.0)"


def h(salt: str, m: int, key: str = "c_custkey") -> str:
    return f"({h32(salt, key)} % {m})"


RAW_COLS = ("client_id, cohort_label, client_type, gender, country, region, date_of_birth, "
            "acquisition_purpose, loan_applied, referral_channel, satisfaction_score")


def raw_ctes() -> str:
    """The buyer view: written from the given tables, with the first and last order found by window."""
    return f"""o AS (SELECT o_custkey, o_totalprice, o_orderdate, cast(left(o_orderpriority, 1) AS integer) AS pr, o_orderstatus AS st,
            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS up,
            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS down FROM orders),
f AS (SELECT o_custkey, max(pr) FILTER (WHERE up = 1) AS p1, max(st) FILTER (WHERE up = 1) AS s1,
             max(pr) FILTER (WHERE down = 1) AS p9, max(st) FILTER (WHERE down = 1) AS s9,
             sum(cast(o_totalprice AS decimal(18,2))) AS value, count(*) AS n, cast(min(o_orderdate) AS date) AS since
      FROM o GROUP BY o_custkey),
bb AS (SELECT concat('B_', lpad(cast(c_custkey AS varchar), 7, '0')) AS client_id, c_mktsegment AS cohort_label,
              CASE WHEN c_acctbal >= 6000 THEN 'Corporate' ELSE 'Individual' END AS client_type,
              CASE WHEN p9 = 4 THEN NULL ELSE CASE s9 WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' ELSE 'Other' END END AS gender,
              n_name AS country,
              CASE WHEN p1 = 4 AND s1 = 'P' THEN NULL
                   ELSE concat(n_name, '/', CASE s1 WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END) END AS region,
              cast(since - cast(11000 + floor(abs(c_acctbal)) AS integer) AS varchar) AS date_of_birth,
              CASE WHEN p9 = 5 AND s9 = 'P' THEN NULL WHEN value >= n * 240000 THEN 'Investment' ELSE 'Personal Use' END AS acquisition_purpose,
              CASE WHEN p1 = 1 AND s1 = 'P' THEN NULL WHEN c_acctbal < 1500 THEN 'Yes' ELSE 'No' END AS loan_applied,
              CASE p1 WHEN 1 THEN 'URGENT' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'MEDIUM' WHEN 5 THEN 'LOW' END AS referral_channel,
              p9 AS satisfaction_score, c_custkey * 2 AS seq, c_acctbal < -900 AS is_exact, c_acctbal > 9900 AS is_changed
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN f ON o_custkey = c_custkey),
r AS (SELECT {RAW_COLS}, seq FROM bb
      UNION ALL
      SELECT client_id, CASE WHEN is_changed THEN 'AUTOMOBILE' ELSE cohort_label END, client_type, gender, country, region, date_of_birth,
             acquisition_purpose, loan_applied, referral_channel,
             CASE WHEN is_changed THEN cast(satisfaction_score % 5 + 1 AS integer) ELSE satisfaction_score END, seq + 1
      FROM bb WHERE is_exact OR is_changed)"""


def dedup_ctes() -> str:
    """The first row of each key, in input order, with its own label."""
    return f"""{raw_ctes()},
d AS (SELECT {RAW_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY client_id, date_of_birth ORDER BY seq) AS rn FROM r) WHERE rn = 1)"""


def _mode(col: str, where: str = "TRUE") -> str:
    return (f"(SELECT {col} FROM d WHERE {col} IS NOT NULL AND {where} "
            f"GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)")


def imputed_ctes() -> str:
    return f"""{dedup_ctes()},
m AS (SELECT {_mode('gender', "client_type = 'Individual'")} AS m_gender,
             {_mode('region')} AS m_region, {_mode('referral_channel')} AS m_channel,
             {_mode('acquisition_purpose')} AS m_purpose, {_mode('loan_applied')} AS m_loan),
i AS (SELECT client_id, cohort_label, client_type,
             CASE WHEN gender IS NULL AND client_type = 'Corporate' THEN 'Not Applicable'
                  WHEN gender IS NULL AND client_type = 'Individual' THEN m_gender
                  ELSE gender END AS gender,
             country, coalesce(region, m_region) AS region, date_of_birth,
             coalesce(acquisition_purpose, m_purpose) AS acquisition_purpose,
             coalesce(loan_applied, m_loan) AS loan_applied,
             coalesce(referral_channel, m_channel) AS referral_channel, satisfaction_score
      FROM d CROSS JOIN m)"""


def age_expr(col: str = "date_of_birth") -> str:
    return (f"cast(trunc(datediff('day', try_cast({col} AS date), date '2024-01-01') / 365.25) AS integer)")


def clean_ctes() -> str:
    return f"""{imputed_ctes()},
b AS (SELECT * EXCLUDE (date_of_birth), {age_expr()} AS age FROM i)"""


def with_raw(body: str) -> str:
    return f"WITH {raw_ctes()}\n{body}"


def with_dedup(body: str) -> str:
    return f"WITH {dedup_ctes()}\n{body}"


def with_imputed(body: str) -> str:
    return f"WITH {imputed_ctes()}\n{body}"


def with_clean(body: str) -> str:
    return f"WITH {clean_ctes()}\n{body}"


def rnd(expr: str, digits: int) -> str:
    """Half-even rounding of a value fixed to 6 decimals, as a double."""
    return f"cast(round_even(cast({expr} AS decimal(38,6)), {digits}) AS double)"
