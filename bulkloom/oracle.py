"""DuckDB SQL for each query, written independently of the operators: windows by exploding rows, intervals by self-joins."""

from __future__ import annotations

from .fixtures import ALLELES, CONTIGS, EFFECTS, READS, STAGE_LOG, VARIANTS

WINDOW, STEP = 200_000, 10_000
_LIMITS = [f"{p}_{k}" for p in ("hb", "lb", "dsi") for k in ("p99", "p95", "m_p99", "m_p95")] + ["gs_p99", "gs_p95"]
_VALUES = ["high_si", "low_si", "dsi", "gs", *_LIMITS]
_ONE_LIMITS = ["b_p99", "b_p95", "b_m_p99", "b_m_p95"]
_Q = {"p99": 0.995, "p95": 0.95, "m_p99": 0.005, "m_p95": 0.05}
_SITE = "chrom, pos, ref, alt, type"


def _r6(x: str) -> str:
    return f"(round(({x}) * 1e6) / 1e6)"


def _g(a1: str, b1: str, a2: str, b2: str) -> str:
    n1, n2 = f"(({a1}) + ({b1}))", f"(({a2}) + ({b2}))"
    p = f"((({a1}) + ({a2}))::DOUBLE / ({n1} + {n2}))"
    cell = lambda o, e: f"CASE WHEN ({o}) > 0 THEN ({o}) * ln(({o})::DOUBLE / ({e})) ELSE 0.0 END"
    return f"CASE WHEN {n1} = 0 OR {n2} = 0 THEN 0.0 ELSE 2 * ({cell(a1, f'{n1} * {p}')} + {cell(b1, f'{n1} * (1 - {p})')} + {cell(a2, f'{n2} * {p}')} + {cell(b2, f'{n2} * (1 - {p})')}) END"


_CANON = f"""
raw AS ({VARIANTS}),
c AS (SELECT * REPLACE (replace(hp_gt, '|', '/') AS hp_gt, replace(lp_gt, '|', '/') AS lp_gt, replace(hb_gt, '|', '/') AS hb_gt, replace(lb_gt, '|', '/') AS lb_gt,
  CAST(string_split(hp_ad, ',') AS INT[]) AS hp_ad, CAST(string_split(lp_ad, ',') AS INT[]) AS lp_ad, CAST(string_split(hb_ad, ',') AS INT[]) AS hb_ad, CAST(string_split(lb_ad, ',') AS INT[]) AS lb_ad) FROM raw),
lc AS (SELECT * FROM c WHERE chrom IN (SELECT chrom FROM c GROUP BY chrom HAVING max(pos) > {WINDOW + STEP}))"""
_BULK = {r: f"{r}_gt <> './.' AND {r}_dp >= {n} AND len({r}_ad) = 2" for r, n in (("hp", 5), ("lp", 5), ("hb", 40), ("lb", 40))}
_HOM = " AND ".join(f"len(string_split({r}_gt, '/')) = 2 AND string_split({r}_gt, '/')[1] = string_split({r}_gt, '/')[2]" for r in ("hp", "lp")) + " AND hp_gt <> lp_gt"
_PASS = {"two_bulk": " AND ".join([*_BULK.values(), _HOM]), "two_bulk_only": f"{_BULK['hb']} AND {_BULK['lb']}", "one_bulk": f"{_BULK['hp']} AND {_BULK['lp']} AND {_BULK['hb']} AND {_HOM}"}


def _filtered(design: str) -> str:
    return f"WITH {_CANON},\nf AS (SELECT * FROM lc WHERE {_PASS[design]})"


def _stats(design: str) -> str:
    alt = lambda r: f"CASE WHEN ref = string_split(lp_gt, '/')[1] THEN {r}_ad[2] ELSE {r}_ad[1] END" if design != "two_bulk_only" else f"{r}_ad[2]"
    own = lambda r: f"CASE WHEN ref = string_split(lp_gt, '/')[1] THEN {r}_ad[1] ELSE {r}_ad[2] END" if design != "two_bulk_only" else f"{r}_ad[1]"
    return f"""{_filtered(design)},
s0 AS (SELECT *, hb_dp AS b_dp, hb_gt AS b_gt, {alt('hb')} AS ha, {own('hb')} AS hr, {alt('lb')} AS la, {own('lb')} AS lr FROM f),
s1 AS (SELECT *, {_r6('ha::DOUBLE / hb_dp')} AS high_si, {_r6('la::DOUBLE / lb_dp')} AS low_si, {_r6(_g('hr', 'ha', 'lr', 'la'))} + 0.0 AS gs FROM s0),
s AS (SELECT *, high_si AS si, {_r6('high_si - low_si')} AS dsi FROM s1)"""


def _pmf(name: str, depths: str, p: float) -> str:
    return f"""{name}k AS (SELECT n, unnest(generate_series(0, n)) AS k FROM ({depths})),
{name} AS (SELECT n, k, {_r6('k::DOUBLE / n')} AS si, exp(sum(CASE WHEN k = 0 THEN 0.0 ELSE ln((n - k + 1)::DOUBLE / k) END) OVER (PARTITION BY n ORDER BY k) + k * ln({p}::DOUBLE) + (n - k) * ln((1 - {p})::DOUBLE)) AS w FROM {name}k)"""


def _quantiles(name: str, source: str, keys: str, value: str, prefix: str) -> str:
    picks = ", ".join(f"min(CASE WHEN share >= {q} - 1e-9 THEN {value} END) AS {prefix}_{k}" for k, q in _Q.items())
    return f"{name} AS (SELECT {keys}, {picks} FROM (SELECT *, sum(w) OVER (PARTITION BY {keys} ORDER BY {value} ROWS UNBOUNDED PRECEDING) AS share FROM {source}) GROUP BY {keys})"


def _thresholds(design: str, p: float = 0.5) -> str:
    """CTEs up to t, with the thresholds of each pair, behind the statistics."""
    if design == "one_bulk":
        return ",\n".join([_stats(design), _pmf("b", "SELECT DISTINCT b_dp AS n FROM s", p), _quantiles("t", "b", "n", "si", "b")])
    grid = f"""pr AS (SELECT DISTINCT hb_dp AS high_dp, lb_dp AS low_dp FROM s),
gr AS (SELECT high_dp, low_dp, h.w * l.w AS w, {_r6('h.si - l.si')} AS dsi, {_r6(_g('h.k', 'high_dp - h.k', 'l.k', 'low_dp - l.k'))} + 0.0 AS gs FROM pr JOIN h ON h.n = high_dp JOIN l ON l.n = low_dp),
gd AS (SELECT high_dp, low_dp, dsi, sum(w) AS w FROM gr GROUP BY ALL),
gg AS (SELECT high_dp, low_dp, gs, sum(w) AS w FROM gr GROUP BY ALL)"""
    parts = [_stats(design), _pmf("h", "SELECT DISTINCT hb_dp AS n FROM s", p), _pmf("l", "SELECT DISTINCT lb_dp AS n FROM s", p), grid]
    parts += [_quantiles("qd", "gd", "high_dp, low_dp", "dsi", "dsi"), _quantiles("qg", "gg", "high_dp, low_dp", "gs", "gs"), _quantiles("qh", "h", "n", "si", "hb"), _quantiles("ql", "l", "n", "si", "lb")]
    cols = ", ".join(_LIMITS)
    parts.append(f"t AS (SELECT high_dp, low_dp, {cols} FROM qd JOIN qg USING (high_dp, low_dp) JOIN qh ON qh.n = high_dp JOIN ql ON ql.n = low_dp)")
    return ",\n".join(parts)


def _with_limits(design: str) -> str:
    join = "b_dp = t.n" if design == "one_bulk" else "hb_dp = high_dp AND lb_dp = low_dp"
    return f"{_thresholds(design)},\nst AS (SELECT s.*, {', '.join('t.' + c for c in (_ONE_LIMITS if design == 'one_bulk' else _LIMITS))} FROM s JOIN t ON {join})"


def _windows(source: str, columns: list[str], window: int = WINDOW, step: int = STEP) -> str:
    """CTE w: every row goes to each of its windows."""
    sums = ", ".join(f"round(sum(CAST(round({c} * 1e6) AS BIGINT))::DOUBLE / count(*)) / 1e6 AS {c}" for c in columns)
    return f"""w0 AS (SELECT *, unnest(generate_series(CAST(greatest(0, floor((pos - {window})::DOUBLE / {step}) + 1) AS BIGINT), CAST(floor(pos::DOUBLE / {step}) AS BIGINT))) AS k FROM {source}),
w AS (SELECT chrom, type, k * {step} + {window} / 2.0 AS centre, count(*) AS n, {sums} FROM w0 GROUP BY chrom, type, k)"""


_TWO = (("ΔSNP-index", "dsi", "dsi", True), ("G-statistic", "gs", "gs", False), ("High-SNP-index", "high_si", "hb", True), ("Low-SNP-index", "low_si", "lb", True))
_ONE = (("SNP-index", "si", "b", True),)


def _all_windows(design: str) -> str:
    return f"{_with_limits(design)},\n{_windows('st', ['si', *_ONE_LIMITS] if design == 'one_bulk' else _VALUES)}"


def _series(design: str) -> str:
    kinds = _ONE if design == "one_bulk" else _TWO
    parts = [f"SELECT chrom, type, CAST(floor(centre) AS BIGINT) AS pos, '{name}' AS statistic, {c} AS value, {p}_p99 AS p99, {p}_p95 AS p95, {f'{p}_m_p99' if low else 'NULL::DOUBLE'} AS p99_low, {f'{p}_m_p95' if low else 'NULL::DOUBLE'} AS p95_low FROM w" for name, c, p, low in kinds]
    return f"{_all_windows(design)},\nse AS ({' UNION ALL '.join(parts)})"


def _qtl(design: str) -> str:
    """Peaks by arg_max, crossings by lag, the interval by joining them."""
    tests, order = [], 0
    for name, _, _, low in _ONE if design == "one_bulk" else _TWO:
        for column, label, sign in (("p99", "99per (peak)", 1), ("p95", "95per (peak)", 1), *((("p99_low", "99per (valley)", -1), ("p95_low", "95per (valley)", -1)) if low else ())):
            tests.append(f"SELECT chrom, type, pos, statistic, '{label}' AS threshold, {order} AS test_order, {sign} AS sign, {sign} * value AS y, {sign} * {column} AS h FROM se WHERE statistic = '{name}'")
            order += 1
    key = "chrom, type, test_order"
    return f"""{_series(design)},
te AS ({' UNION ALL '.join(tests)}),
nu AS (SELECT *, row_number() OVER o AS i, lag(y) OVER o AS y0, lag(h) OVER o AS h0 FROM te WINDOW o AS (PARTITION BY {key} ORDER BY pos)),
cr AS (SELECT {key}, i, pos FROM nu WHERE (y0 < h0 AND y > h) OR (y0 > h0 AND y < h)),
pk AS (SELECT * FROM (SELECT {key}, statistic, threshold, sign, y, i, row_number() OVER (PARTITION BY {key} ORDER BY y DESC, i) AS rn FROM nu WHERE y > h) WHERE rn = 1),
q AS (SELECT pk.chrom, pk.type, max(CASE WHEN cr.i < pk.i THEN cr.pos END) AS qtl_start, min(CASE WHEN cr.i > pk.i THEN cr.pos END) AS qtl_end, any_value(pk.sign * pk.y) AS peak, any_value(statistic) AS statistic, any_value(threshold) AS threshold, pk.test_order
  FROM pk JOIN cr ON pk.chrom = cr.chrom AND pk.type = cr.type AND pk.test_order = cr.test_order GROUP BY pk.chrom, pk.type, pk.test_order HAVING count(*) >= 2)"""


_QTL_ROWS = "SELECT chrom, type, qtl_start, qtl_end, peak, statistic, threshold, test_order FROM q WHERE qtl_start IS NOT NULL AND qtl_end IS NOT NULL"
_RAW = f"WITH v AS ({VARIANTS})"
_SNP = (("QD2", "qd < 2.0"), ("QUAL30", "qual < 30.0"), ("SOR3", "sor > 3.0"), ("FS60", "fs > 60.0"), ("MQ40", "mq < 40.0"), ("MQRankSum-12.5", "mq_rank_sum < -12.5"), ("ReadPosRankSum-8", "read_pos_rank_sum < -8.0"))
_INDEL = (("QD2", "qd < 2.0"), ("QUAL30", "qual < 30.0"), ("FS200", "fs > 200.0"), ("ReadPosRankSum-20", "read_pos_rank_sum < -20.0"))


def _fails(rules) -> str:
    return "concat_ws(';', " + ", ".join(f"CASE WHEN {t} THEN '{n}' END" for n, t in rules) + ")"


_LOG = f"WITH lg AS ({STAGE_LOG})"
_CTG = f"WITH ct AS ({CONTIGS})"
_RD = f"WITH rd AS ({READS})"
_COMPLETED = "SELECT DISTINCT program, sample, chromosome FROM lg WHERE status = 'COMPLETED'"
_UNMAPPED = f"{_RD} SELECT qname, flag, rname, pos FROM rd WHERE (flag & 12) <> 0 AND (flag & 256) = 0"
_EFF = ("impact", "functional_class", "codon_change", "amino_acid_change", "gene_name", "transcript_biotype", "gene_coding", "transcript_id", "errors", "warnings")
_BITS = (("paired", 1), ("proper", 2), ("unmapped", 4), ("mate_unmapped", 8), ("reverse", 16), ("mate_reverse", 32), ("read1", 64), ("read2", 128), ("secondary", 256), ("duplicate", 1024), ("supplementary", 2048))
_MEASURES = [("total", "true"), *((n, f"(flag & {b}) <> 0") for n, b in _BITS), ("mapped", "(flag & 4) = 0"), ("both_mapped", "(flag & 1) <> 0 AND (flag & 12) = 0")]
_OWN = "CASE WHEN (flag & 1) = 0 THEN 'UNPAIRED' WHEN (flag & 64) <> 0 THEN 'FIRST_OF_PAIR' ELSE 'SECOND_OF_PAIR' END"
_ALN = "count(*) AS total, count(*) FILTER ((flag & 4) = 0) AS aligned, avg(length(seq)) AS mean_length, avg(mapq) AS mean_mapq FROM rd WHERE (flag & 256) = 0"
_DUP = f"""{_RD},
pr AS (SELECT *, (flag & 2308) = 0 AS part, concat(rname, '|', five_prime, '|', flag & 16) AS x FROM rd),
pa AS (SELECT library, qname, sum(base_quality_sum) AS score, min(x) AS x1, max(x) AS x2 FROM pr WHERE part GROUP BY library, qname HAVING count(*) = 2 AND min(flag & 1) = 1),
pd AS (SELECT library, qname, row_number() OVER (PARTITION BY library, x1, x2 ORDER BY score DESC, qname) > 1 AS dup FROM pa),
ends AS (SELECT library, x1 AS x FROM pa UNION SELECT library, x2 FROM pa),
fr AS (SELECT *, row_number() OVER (PARTITION BY library, x ORDER BY base_quality_sum DESC, qname, flag) > 1 AS later FROM pr WHERE part AND (library, qname) NOT IN (SELECT (library, qname) FROM pa)),
fd AS (SELECT fr.qname, fr.flag, fr.library, later OR ends.x IS NOT NULL AS dup FROM fr LEFT JOIN ends ON fr.library = ends.library AND fr.x = ends.x),
du AS (SELECT pr.*, coalesce(CASE WHEN part THEN coalesce(pd.dup, fd.dup) END, false) AS is_dup FROM pr LEFT JOIN pd ON pr.library = pd.library AND pr.qname = pd.qname LEFT JOIN fd ON pr.library = fd.library AND pr.qname = fd.qname AND pr.flag = fd.flag)"""
_GT = {p: f"replace({p}_gt, '|', '/')" for p in ("hp", "lp", "hb", "lb")}
_FIELDS = [f"max({_GT[p]}) AS {p}_gt, max({p}_ad) AS {p}_ad, max({p}_dp) AS {p}_dp, max(pos % 60 + {k})::INT AS {p}_gq" for k, p in enumerate(("hp", "lp"))] + [f"coalesce(max(CASE WHEN pos % 3 = {j} THEN {_GT['hb']} END), './.') AS b{j}_gt, max(CASE WHEN pos % 3 = {j} THEN hb_ad END) AS b{j}_ad, max(CASE WHEN pos % 3 = {j} THEN hb_dp ELSE 0 END) AS b{j}_dp, max(CASE WHEN pos % 3 = {j} THEN pos % 60 + 2 ELSE 0 END)::INT AS b{j}_gq" for j in range(3)]
_COHORT = f"{_RAW}, cg AS (SELECT chrom, pos, ref, alt, {', '.join(_FIELDS)} FROM v GROUP BY chrom, pos, ref, alt)"


def _tsv(design: str = "two_bulk") -> str:
    """The statistics as text in the order of the sink."""
    six = lambda c, name: f"printf('%.6f', {c}) AS \"{name}\""
    role = lambda p, s: f"{p}_gt AS \"{s}_GT\", array_to_string({p}_ad, ',') AS \"{s}_AD\", {p}_dp::VARCHAR AS \"{s}_DP\""
    lim = lambda p, s, ks=("p99", "p95", "m_p99", "m_p95"): ", ".join(six(f"{p}_{k}", f"{s}_{k}") for k in ks)
    site = ['chrom AS "CHROM"', 'pos::VARCHAR AS "POS"', 'ref AS "REF"', 'alt AS "ALT"', 'type AS "TYPE"']
    parents = [role("lp", "LP"), role("hp", "HP")] if design != "two_bulk_only" else []
    if design == "one_bulk":
        cols = [*site, *parents, role("hb", "HB"), six("si", "HB_SNP_INDEX"), lim("b", "HB")]
    else:
        cols = [*site, *parents, role("lb", "LB"), role("hb", "HB"), six("high_si", "HB_SNP_INDEX"), six("low_si", "LB_SNP_INDEX"), six("dsi", "DELTA_SNP_INDEX"), six("gs", "G_STATISTIC"), lim("hb", "HB"), lim("lb", "LB"), lim("dsi", "dsi"), lim("gs", "gs", ("p99", "p95"))]
    return f"{_with_limits(design)} SELECT {', '.join(cols)} FROM st"


def _roles(*roles: str) -> str:
    cells = ", ".join(f"replace({p}_gt, '|', '/') AS {q}_gt, {p}_ad AS {q}_ad, {p}_dp AS {q}_dp" for p, q in (r.split(":") if ":" in r else (r, r) for r in roles))
    return f"{_RAW} SELECT chrom, pos, ref, alt, qual, type, {cells} FROM v"


_SNPEFF = ("effect", "impact", "functional_class", "codon_change", "amino_acid_change", "gene_name", "transcript_biotype", "gene_coding", "transcript_id")


def _effects(first: str) -> str:
    named = [*(f"snpeff_{k}" for k in _SNPEFF), "errors", "warnings"]
    cells = ["trim(regexp_extract(eff, '^([^(]+)', 1))", *(f"trim(coalesce(p[{i + 1}], ''))" for i in range(10))]
    return f"WITH ef AS ({EFFECTS}), pa AS (SELECT *, string_split(regexp_extract(eff, '\\(([^)]*)\\)', 1), '|') AS p FROM ef) SELECT {first}, " + ", ".join(f"{c} AS {n}" for c, n in zip(cells, named, strict=True)) + " FROM pa"


_PASSING = f"(type = 'SNP' AND {_fails(_SNP)} = '' OR type = 'INDEL' AND {_fails(_INDEL)} = '')"
_ALT2 = "CASE WHEN type = 'INDEL' THEN concat(alt, 'T') ELSE alt END AS alt"
_MATE = "CASE WHEN (flag & 64) <> 0 THEN 1 ELSE 2 END"
_BACK = "(flag & 16) <> 0"

ORACLE_SQL = {
    "bsa_filter": f"{_filtered('two_bulk')} SELECT {_SITE}, hp_gt, lp_gt, hb_dp, lb_dp FROM f",
    "bsa_filter_two_bulk_only": f"{_filtered('two_bulk_only')} SELECT {_SITE}, hb_gt, lb_gt, hb_dp, lb_dp FROM f",
    "bsa_filter_one_bulk": f"{_filtered('one_bulk')} SELECT {_SITE}, hp_gt, lp_gt, hb_gt AS b_gt, hb_dp AS b_dp FROM f",
    "filter_funnel": f"{_filtered('two_bulk')} SELECT (SELECT count(*) FROM c) AS original, (SELECT count(*) FROM lc) AS on_long_contigs, (SELECT count(*) FROM f) AS filtered",
    "short_contigs": f"{_RAW} SELECT chrom, max(pos) AS max_pos, max(pos) > {WINDOW + STEP} AS kept FROM v GROUP BY chrom",
    "bsa_stats": f"{_stats('two_bulk')} SELECT {_SITE}, hb_dp, lb_dp, high_si, low_si, dsi, gs FROM s",
    "bsa_two_bulk_only_stats": f"{_stats('two_bulk_only')} SELECT {_SITE}, hb_dp, lb_dp, high_si, low_si, dsi, gs FROM s",
    "bsa_one_bulk_stats": f"{_stats('one_bulk')} SELECT {_SITE}, b_dp, si FROM s",
    "depth_pairs": f"{_filtered('two_bulk')} SELECT DISTINCT hb_dp AS high_dp, lb_dp AS low_dp FROM f",
    "null_pmf": f"{_filtered('two_bulk')},\n{_pmf('b', 'SELECT DISTINCT hb_dp AS n FROM f', 0.25)} SELECT n, k, si, round(w, 9) AS w FROM b",
    "null_thresholds_two_bulk": f"{_thresholds('two_bulk')} SELECT * FROM t",
    "null_thresholds_two_bulk_bc": f"{_thresholds('two_bulk', 0.25)} SELECT * FROM t",
    "null_thresholds_one_bulk": f"{_thresholds('one_bulk')} SELECT n, b_p99 AS p99, b_p95 AS p95, b_m_p99 AS m_p99, b_m_p95 AS m_p95 FROM t",
    "bsa_stats_with_thresholds": f"{_with_limits('two_bulk')} SELECT {_SITE}, hb_dp, lb_dp, {', '.join(_VALUES)} FROM st",
    "bsa_one_bulk_with_thresholds": f"{_with_limits('one_bulk')} SELECT {_SITE}, b_dp, si, {', '.join(_ONE_LIMITS)} FROM st",
    "bsa_window_dsi": f"{_stats('two_bulk')},\n{_windows('s', ['dsi'])} SELECT * FROM w",
    "bsa_window_uneven": f"{_stats('two_bulk')},\n{_windows('s', ['dsi'], 95_000, 20_000)} SELECT * FROM w",
    "bsa_windows_two_bulk": f"{_all_windows('two_bulk')} SELECT * FROM w",
    "bsa_windows_two_bulk_only": f"{_all_windows('two_bulk_only')} SELECT * FROM w",
    "bsa_windows_one_bulk": f"{_all_windows('one_bulk')} SELECT * FROM w",
    "bsa_series": f"{_series('two_bulk')} SELECT * FROM se",
    "qtl_two_bulk": f"{_qtl('two_bulk')} {_QTL_ROWS}",
    "qtl_two_bulk_only": f"{_qtl('two_bulk_only')} {_QTL_ROWS}",
    "qtl_one_bulk": f"{_qtl('one_bulk')} {_QTL_ROWS}",
    "qtl_table": f"{_qtl('two_bulk')} SELECT chrom AS \"CHROM\", qtl_start AS \"QTLstart\", qtl_end AS \"QTLend\", peak AS \"PEAK\", statistic AS \"STATISTIC\", threshold AS \"THRESHOLD\", type AS \"TYPE\" FROM q WHERE qtl_start IS NOT NULL AND qtl_end IS NOT NULL",
    "statistics_tsv": _tsv(),
    "select_type": f"{_RAW} SELECT {_SITE}, qual FROM v WHERE type = 'INDEL'",
    "variant_types": f"WITH al AS ({ALLELES}), l AS (SELECT *, length(ref) AS r, list_transform(string_split(alt, ','), lambda x: length(x)) AS a FROM al), m AS (SELECT *, len(list_filter(a, lambda x: x = r)) AS same FROM l) SELECT p_partkey, ref, alt, CASE WHEN same = 0 THEN 'INDEL' WHEN same < len(a) THEN 'MIXED' WHEN r = 1 THEN 'SNP' ELSE 'MNP' END AS type FROM m",
    "hard_filter_snps": f"{_RAW} SELECT {_SITE}, coalesce(nullif({_fails(_SNP)}, ''), 'PASS') AS filter FROM v WHERE type = 'SNP'",
    "hard_filter_indels": f"{_RAW} SELECT {_SITE}, coalesce(nullif({_fails(_INDEL)}, ''), 'PASS') AS filter FROM v WHERE type = 'INDEL'",
    "merge_calls": f"{_RAW} SELECT {_SITE} FROM v WHERE type = 'SNP' AND {_fails(_SNP)} = '' UNION ALL SELECT {_SITE} FROM v WHERE type = 'INDEL' AND {_fails(_INDEL)} = ''",
    "contig_calls": f"{_RAW} SELECT {_SITE} FROM v",
    "cohort_combine": f"{_COHORT} SELECT * FROM cg",
    "known_sites": f"{_RAW} SELECT DISTINCT chrom, pos, ref, alt FROM v WHERE {_PASSING} AND (hp_gt <> './.' OR lp_gt <> './.')",
    "eff_split": f"WITH ef AS ({EFFECTS}), pa AS (SELECT *, string_split(regexp_extract(eff, '\\(([^)]*)\\)', 1), '|') AS p FROM ef) SELECT p_partkey, chrom, pos, trim(regexp_extract(eff, '^([^(]+)', 1)) AS effect, " + ", ".join(f"trim(coalesce(p[{i + 1}], '')) AS {f}" for i, f in enumerate(_EFF)) + " FROM pa",
    "stage_completed": f"{_LOG} {_COMPLETED}",
    "stage_pending": f"{_LOG} SELECT p.program, s.sample, c.chromosome FROM (SELECT DISTINCT program FROM lg) p, (SELECT DISTINCT sample FROM lg) s, (SELECT DISTINCT chromosome FROM lg) c EXCEPT {_COMPLETED}",
    "stage_stream": f"{_LOG} {_COMPLETED}",
    "sample_discovery": f"{_COHORT} SELECT x.id, x.name, (SELECT count(*) FROM cg) AS n_sites FROM (VALUES (0, 'None'), (1, 'hp'), (2, 'lp'), (3, 'b0'), (4, 'b1'), (5, 'b2')) x(id, name)",
    "contig_filter": f"{_CTG} SELECT * FROM ct WHERE length >= 200",
    "contig_rename": f"{_CTG} SELECT contig_no, sample, concat(sample, '_scaff_', row_number() OVER (PARTITION BY sample ORDER BY contig_no)) AS name, length FROM ct",
    "contig_keys": f"{_CTG} SELECT contig_no, replace(name, '.', '_') AS key FROM ct",
    "contig_latest": f"{_CTG} SELECT max(version) AS version FROM ct",
    "contig_append_latest": f"{_CTG} SELECT contig_no, name, sample, length, 3 AS version FROM ct WHERE version = 2 UNION ALL SELECT contig_no, concat(sample, '_scaff_', row_number() OVER (PARTITION BY sample ORDER BY contig_no)), sample, length, 3 FROM ct WHERE version = 3 AND length >= 200",
    "unmapped_reads": _UNMAPPED,
    "unmapped_union": _UNMAPPED,
    "read_coordinate_sort": f"{_RD} SELECT qname, flag, rname, pos FROM rd",
    "flag_summary": _RD + " " + " UNION ALL ".join(f"SELECT '{n}' AS measure, count(*) FILTER (({t}) AND (flag & 512) = 0) AS passed, count(*) FILTER (({t}) AND (flag & 512) <> 0) AS failed FROM rd" for n, t in _MEASURES),
    "alignment_summary": f"{_RD} SELECT {_OWN} AS category, {_ALN} GROUP BY 1 UNION ALL SELECT 'PAIR' AS category, {_ALN} AND (flag & 1) <> 0 GROUP BY 1",
    "insert_size": f"{_RD}, i AS (SELECT abs(tlen) AS x FROM rd WHERE (flag & 64) <> 0 AND tlen <> 0), m AS (SELECT quantile_cont(x, 0.5) AS md FROM i), z AS (SELECT count(*) AS pairs, sum(x)::DOUBLE AS sx, sum(x::BIGINT * x)::DOUBLE AS sxx, any_value(md) AS median, quantile_cont(abs(x - md), 0.5) AS mad, min(x) AS smallest, max(x) AS largest FROM i, m) SELECT pairs, {_r6('sx / pairs')} AS mean, {_r6('sqrt((sxx - sx * (sx / pairs)) / (pairs - 1))')} AS deviation, median, mad, smallest, largest FROM z",
    "insert_size_histogram": f"{_RD} SELECT abs(tlen) AS insert_size, count(*) AS n FROM rd WHERE (flag & 64) <> 0 AND tlen <> 0 GROUP BY 1",
    "mark_duplicates": f"{_DUP} SELECT qname, flag, library, is_dup FROM du",
    "duplicate_metrics": f"{_DUP} SELECT library, count(*) AS n_reads, count(*) FILTER (is_dup) AS n_duplicates FROM du GROUP BY library",
    "wide_read_two_bulk": _roles("hp", "lp", "hb", "lb"),
    "wide_read_two_bulk_only": _roles("hb", "lb"),
    "wide_read_one_bulk": _roles("hp", "lp", "hb:b"),
    "vcf_read": f"{_RAW} SELECT chrom, pos, ref, {_ALT2}, type, qual, qd, fs, sor, mq, mq_rank_sum, read_pos_rank_sum, CASE WHEN type = 'SNP' THEN hp_gt END AS hp_gt, hb_ad, hb_dp FROM v",
    "vcf_post_process": f"{_RAW} SELECT chrom, pos, ref, {_ALT2}, type FROM v WHERE {_PASSING}",
    "vcf_sample_calls": f"{_RAW} " + " UNION ALL ".join(f"SELECT '{p.upper()}' AS sample, count(*) AS n, sum({p}_dp)::BIGINT AS dp, sum(string_split({p}_ad, ',')[1]::INT)::BIGINT AS ad0 FROM v WHERE {p}_gt <> './.'" for p in ("hp", "lp", "hb", "lb")),
    "run_two_bulk": f"{_all_windows('two_bulk')} SELECT * FROM w",
    "run_two_bulk_tsv": _tsv(),
    "run_two_bulk_only_tsv": _tsv("two_bulk_only"),
    "run_one_bulk_tsv": _tsv("one_bulk"),
    "effects_read": _effects("p_partkey::VARCHAR AS p_partkey, chrom, pos::VARCHAR AS pos"),
    "effects_rejected": "SELECT concat('bad', chr(9), 'line') AS value",
    "vcf_effects": _effects("chrom, pos::VARCHAR AS pos, 'A/C' AS gt"),
    "stage_log_files": f"{_LOG} SELECT time, tool, program, sample, chromosome, status, concat('run ', program) AS cmd FROM lg",
    "fasta_files": f"{_CTG} SELECT name, concat(repeat('ACGT', CAST(length % 50 AS INT)), 'TTA') AS seq, length % 50 * 4 + 3 AS length FROM ct",
    "sam_read": f"{_RD} SELECT qname, flag, library, rname, pos, mapq, tlen, five_prime, base_quality_sum FROM rd",
    "sam_duplicates": f"{_DUP} SELECT qname, flag, library, is_dup FROM du",
    "fastq_files": f"{_RD} SELECT unnest([concat('@', qname, '/', {_MATE}), CASE WHEN {_BACK} THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END, '+', CASE WHEN {_BACK} THEN reverse(qual) ELSE qual END]) AS value, {_MATE} AS mate FROM rd WHERE (flag & 12) <> 0 AND (flag & 256) = 0",
    "calls_resume": f"{_RAW} SELECT {_SITE} FROM v WHERE {_PASSING}",
    "contig_pruned": f"{_RAW} SELECT {_SITE} FROM v WHERE chrom IN (SELECT chrom FROM v GROUP BY chrom HAVING avg(qual) > (SELECT avg(qual) FROM v))",
    "short_contigs_stored": f"{_RAW} SELECT chrom, max(pos) AS max_pos, max(pos) > {WINDOW + STEP} AS kept FROM v GROUP BY chrom",
    "stage_status": f"{_LOG}, cp AS ({_COMPLETED}) SELECT p.program, s.sample, c.chromosome, (p.program, s.sample, c.chromosome) IN (SELECT (program, sample, chromosome) FROM cp) AS done FROM (SELECT DISTINCT program FROM lg) p, (SELECT DISTINCT sample FROM lg) s, (SELECT DISTINCT chromosome FROM lg) c",
    "stage_log_rejected": f"""{_LOG}, li AS (SELECT status, concat('{{"time":"2024-01-01T00:00:00Z","msg":"', tool, '","PROGRAM":"', program, '","SAMPLE":"', sample, '","CHROMOSOME":"', chromosome, '"') AS line FROM lg WHERE status <> 'COMPLETED')
      SELECT CASE WHEN status = 'FAILED' THEN 'no JSON' ELSE 'no STATUS' END AS reason, CASE WHEN status = 'FAILED' THEN substr(line, 1, 40) ELSE concat(line, '}}') END AS line, count(*) AS n FROM li GROUP BY ALL""",
    "vcf_united": f"{_RAW} SELECT chrom, pos, ref, {_ALT2}, type, CASE WHEN type = 'SNP' THEN hp_dp::VARCHAR ELSE '' END AS hp_dp, CASE WHEN type = 'SNP' THEN lp_dp::VARCHAR ELSE '' END AS lp_dp, hb_dp::VARCHAR AS hb_dp, CASE WHEN type = 'INDEL' THEN lb_dp::VARCHAR ELSE '' END AS lb_dp, hb_ad, true AS has_file FROM v",
    "roles_long": f"{_roles('hp', 'lp', 'hb', 'lb')} WHERE type = 'SNP'",
    "cohort_grown": f"{_COHORT} SELECT * FROM cg",
    "fasta_chunks": f"{_CTG} SELECT contig_no, name, concat(repeat('ACGT', CAST(length % 500 AS INT)), 'TTA') AS seq, length % 500 * 4 + 3 AS length FROM ct",
}
