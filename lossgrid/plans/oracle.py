"""SQL text shared by the oracles. It restates each definition in plain SQL: full sorts, global windows,
row numbers. Nothing here runs on Spark."""

from __future__ import annotations

from collections.abc import Sequence

from lossgrid.functions import normal, uniform

LOAN_BOOK = """
li AS (
  SELECT l_orderkey, sum(l_quantity) AS qty, sum(l_extendedprice) AS ext, count(*) AS n_lines,
         max(l_linenumber) AS max_line, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_returned
  FROM lineitem GROUP BY l_orderkey),
first_order AS (SELECT o_custkey AS ck, min(o_orderdate) AS first_dt FROM orders GROUP BY o_custkey),
loan AS (
  SELECT o_orderkey AS id, o_custkey AS member_id, c_mktsegment AS segment, o_totalprice AS loan_amnt,
    round(ext, 2) AS funded_amnt, o_totalprice / 36e0 AS installment, c_acctbal * 12e0 AS annual_inc,
    CAST(CAST(qty AS BIGINT) AS VARCHAR) || '%' AS revol_util, c_acctbal + o_totalprice / 10e0 AS revol_bal,
    ((o_orderkey * 37) % 1200) / 1e0 AS dti, 5e0 + ((o_orderkey * 23) % 200) / 10e0 AS int_rate,
    o_orderdate AS issue_ts, strftime(o_orderdate, '%b-%Y') AS issue_d,
    first_dt AS earliest_ts, strftime(first_dt, '%b-%Y') AS earliest_cr_line,
    CASE o_orderstatus WHEN 'F' THEN 'Fully Paid' WHEN 'P' THEN 'Charged Off' ELSE 'Current' END AS loan_status,
    substr('ABCDEFG', CAST(substr(o_orderpriority, 1, 1) AS INT), 1) AS grade,
    (560 + (o_orderkey * 7919) % 300) / 1e0 AS fico_range_low,
    (564 + (o_orderkey * 7919) % 300) / 1e0 AS fico_range_high,
    n_lines AS open_acc, max_line AS total_acc, CAST(n_returned AS BIGINT) AS delinq_2yrs,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 2 AS INT) END AS pub_rec,
    CAST((o_orderkey * 13) % 5 AS INT) AS inq_last_6mths,
    CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 60 AS INT) END AS mths_since_last_delinq,
    o_totalprice AS exposure, o_totalprice * (20 + (o_orderkey * 11) % 61) / 100e0 AS outstanding,
    0.8e0 - ((o_orderkey * 31) % 50) / 100e0 AS recovery,
    ((o_orderkey * 7919) % 1000 + 0.5e0) / 2500e0 AS pd_12m,
    ((o_orderkey * 104729) % 1000 + 0.5e0) / 5000e0 AS original_pd,
    0.2e0 + ((o_orderkey * 31) % 50) / 100e0 AS lgd, 1 + (o_orderkey % 5) AS term_years,
    (o_orderkey * 17) % 120 AS dpd, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS y,
    CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 1 ELSE 0 END AS is_ref
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN li ON o_orderkey = l_orderkey LEFT JOIN first_order ON o_custkey = ck)"""


def on_loans(select: str, *ctes: str) -> str:
    """A query over the loan book with further CTEs."""
    return f"WITH {', '.join([LOAN_BOOK, *ctes])} {select}"


def horner(x: str, coefficients: Sequence[float]) -> str:
    text = f"{coefficients[-1]!r}::DOUBLE"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r}::DOUBLE)"
    return text


def with_quantile(source: str, p: str, out: str) -> str:
    """SELECT *, Φ⁻¹(p) AS out."""
    r = f"(0.180625e0 - ({p} - 0.5e0) * ({p} - 0.5e0))"
    near, far = "(_t - 1.6e0)", "(_t - 5e0)"
    outer = (
        f"CASE WHEN _t <= 5e0 THEN {horner(near, normal.QUANTILE_NEAR_NUM)} / {horner(near, normal.QUANTILE_NEAR_DEN)} "
        f"ELSE {horner(far, normal.QUANTILE_FAR_NUM)} / {horner(far, normal.QUANTILE_FAR_DEN)} END"
    )
    tail = f"CASE WHEN {p} > 0 AND {p} < 1 THEN sqrt(-ln(CASE WHEN {p} < 0.5e0 THEN {p} ELSE 1e0 - {p} END)) END"
    return (
        f"SELECT * EXCLUDE (_t), CASE WHEN {p} <= 0 THEN '-inf'::DOUBLE WHEN {p} >= 1 THEN 'inf'::DOUBLE "
        f"WHEN abs({p} - 0.5e0) <= 0.425e0 THEN ({p} - 0.5e0) * {horner(r, normal.QUANTILE_CENTRE_NUM)} / "
        f"{horner(r, normal.QUANTILE_CENTRE_DEN)} WHEN {p} < 0.5e0 THEN -({outer}) ELSE {outer} END AS {out} "
        f"FROM (WITH m AS MATERIALIZED (SELECT *, {tail} AS _t FROM ({source})) SELECT * FROM m)"
    )


def with_cdf(source: str, x: str, out: str) -> str:
    """SELECT *, Φ(x) AS out."""
    tail = "(_a + 0.65e0)"
    for k in ("4e0", "3e0", "2e0", "1e0"):
        tail = f"(_a + {k} / {tail})"
    low = (
        f"CASE WHEN _a > 37e0 THEN 0e0 WHEN _a < {normal.CDF_SPLIT!r}::DOUBLE THEN exp(-(_a * _a) / 2e0) * "
        f"{horner('_a', normal.CDF_NUM)} / {horner('_a', normal.CDF_DEN)} "
        f"ELSE exp(-(_a * _a) / 2e0) / {tail} / {normal.ROOT_TWO_PI!r}::DOUBLE END"
    )
    return (
        f"SELECT * EXCLUDE (_a, _l), CASE WHEN {x} > 0 THEN 1e0 - _l ELSE _l END AS {out} "
        f"FROM (WITH m AS MATERIALIZED (SELECT *, {low} AS _l FROM (SELECT *, abs({x}) AS _a FROM ({source}))) SELECT * FROM m)"
    )


def _fifth(source: str, out: str, x: str) -> str:
    p = uniform.PRIME
    return (
        f"SELECT * EXCLUDE (_b, _s), ((_s * _s) % {p} * _b) % {p} AS {out} FROM "
        f"(SELECT *, (_b * _b) % {p} AS _s FROM (SELECT *, CAST(({x}) % {p} AS BIGINT) AS _b FROM ({source})))"
    )


def with_uniform(source: str, entity: str, run: str, seed: int, out: str) -> str:
    """SELECT *, the keyed uniform AS out; keys must not be negative."""
    p, k = uniform.PRIME, uniform.ROUND_KEYS
    one = _fifth(source, "_u1", f"{entity} % {p} + {(seed * k[1] + k[0]) % p}")
    two = _fifth(one, "_u2", f"_u1 + {run} * {k[2]} + {k[3]}")
    three = _fifth(two, "_u3", f"_u2 + ({entity} // {p}) % {p} + {k[4]}")
    return f"SELECT * EXCLUDE (_u1, _u2, _u3), (_u3 + 0.5e0) / {p}e0 AS {out} FROM ({three})"


def long_form(cols: Sequence[str], keep: Sequence[str] = (), source: str = "loan") -> str:
    """UNION ALL of (keep, feature, value)."""
    head = "".join(f"{k}, " for k in keep)
    return " UNION ALL ".join(f"SELECT {head}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {source}" for c in cols)


def quantile_ctes(source: str, probs: Sequence[float], out: str, keys: Sequence[str] = ("feature",)) -> str:
    """CTEs giving (keys, n, q0, q1, ...) by full ranking of (keys, value) rows."""
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    head = "".join(f"{k}, " for k in keys)
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    cols = []
    for i, q in enumerate(probs):
        at = f"({q!r}::DOUBLE * (n - 1))"
        lo = f"max(CASE WHEN rk = floor({at}) THEN value END)"
        hi = f"max(CASE WHEN rk = least(floor({at}) + 1, n - 1) THEN value END)"
        cols.append(f"{lo} + ({hi} - {lo}) * max({at} - floor({at})) AS q{i}")
    return (
        f"{out}_ranked AS (SELECT {head}value, row_number() OVER ({part} ORDER BY value) - 1 AS rk, "
        f"count(*) OVER ({part}) AS n FROM ({source}) WHERE value IS NOT NULL), "
        f"{out} AS (SELECT {head}max(n) AS n, {', '.join(cols)} FROM {out}_ranked {group})"
    )


def edge_list(n: int) -> str:
    return f"list_sort(list_distinct([{', '.join(f'q{i}' for i in range(n + 1))}]))"


def edge_bin(x: str = "value", edges: str = "edges") -> str:
    """Left-closed bin index, last bin closed, NULL outside."""
    at = f"len(list_filter({edges}, lambda e: e <= {x}))"
    return (
        f"CASE WHEN {at} >= 1 AND {at} < len({edges}) THEN {at} - 1 "
        f"WHEN {x} = {edges}[len({edges})] THEN len({edges}) - 2 END"
    )


def score_ctes(source: str, keys: Sequence[str] = (), out: str = "st") -> str:
    """CTE of running class counts per distinct score; source has keys, score, y, w."""
    head = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return (
        f"{out}_d AS (SELECT {head}score, sum(CASE WHEN y = 1 THEN w ELSE 0e0 END) AS pos, "
        f"sum(CASE WHEN y = 0 THEN w ELSE 0e0 END) AS neg, "
        f"sum(CASE WHEN y = 1 THEN 1e0 ELSE 0e0 END) AS c1, sum(CASE WHEN y = 0 THEN 1e0 ELSE 0e0 END) AS c0 "
        f"FROM ({source}) GROUP BY {head}score), "
        f"{out} AS (SELECT *, "
        + ", ".join(
            f"sum({c}) OVER ({part} ORDER BY score) AS {c}_upto, sum({c}) OVER ({part}) AS {c}_total"
            for c in ("pos", "neg", "c1", "c0")
        )
        + f" FROM {out}_d)"
    )


AUC = (
    "CASE WHEN max(pos_total) > 0 AND max(neg_total) > 0 "
    "THEN sum(pos * (neg_upto - neg + neg / 2e0)) / (max(pos_total) * max(neg_total)) ELSE 0.5e0 END"
)
KS = "coalesce(max(abs(c0_upto / nullif(c0_total, 0e0) - c1_upto / nullif(c1_total, 0e0))), 0e0)"


def kolmogorov(d: str, n: str, m: str) -> str:
    """Limiting two-sided p-value by the alternating series with many terms."""
    z = f"({d} * sqrt({n}::DOUBLE * {m} / ({n} + {m})))"
    return (
        f"CASE WHEN {z} < 0.2e0 THEN 1e0 ELSE greatest(0e0, least(1e0, 2e0 * list_sum(list_transform(range(1, 101), "
        f"lambda k: (CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END) * exp(-2e0 * k * k * {z} * {z}))))) END"
    )
