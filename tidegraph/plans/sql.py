"""The same rows in DuckDB's SQL, written independently of the operators. Queries whose numerics SQL cannot express have none."""

from __future__ import annotations

SQL: dict[str, str] = {}

CH = """ch AS (SELECT user_id AS electrode, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS sample, value, event_type, ts FROM events)"""
UP = CH + """,
lim AS (SELECT electrode, avg(value) AS mu, stddev_samp(value) AS threshold FROM ch GROUP BY electrode),
up AS (SELECT ch.electrode, ch.sample, mu - ch.value AS v, threshold FROM ch JOIN lim ON ch.electrode = lim.electrode)"""
CAND = UP + """,
hs AS (SELECT *, v < -threshold AS hot FROM up),
hw AS (SELECT *, coalesce(lag(hot) OVER (PARTITION BY electrode ORDER BY sample), FALSE) AS was FROM hs),
rn AS (SELECT *, sum(CASE WHEN hot AND NOT was THEN 1 ELSE 0 END) OVER (PARTITION BY electrode ORDER BY sample) AS run FROM hw),
fr AS (SELECT *, row_number() OVER (PARTITION BY electrode, run ORDER BY v, sample) AS lowest FROM rn WHERE hot OR was),
cand AS (SELECT electrode, min(sample) AS up, max(CASE WHEN NOT hot THEN sample END) AS down, max(CASE WHEN lowest = 1 THEN sample END) AS spike_time, -min(v) AS amplitude FROM fr GROUP BY electrode, run HAVING max(CASE WHEN NOT hot THEN sample END) IS NOT NULL),
gaps AS (SELECT *, down - up AS width, spike_time - lag(spike_time) OVER (PARTITION BY electrode ORDER BY spike_time) AS gap FROM cand),
kept AS (SELECT *, width <= 3 AND (gap IS NULL OR gap > 3) AS kept FROM gaps),
sp AS (SELECT electrode, spike_time, width, amplitude FROM kept WHERE kept)"""
TTL = CH + """,
te AS (SELECT *, event_type = 'error' AS hot, coalesce(lag(event_type = 'error') OVER (PARTITION BY electrode ORDER BY sample), FALSE) AS was FROM ch),
edges AS (SELECT electrode, sample FROM te WHERE hot AND NOT was)"""
ADJ = """adj AS (SELECT a.electrode, b.electrode AS neighbor, CASE WHEN b.electrode = a.electrode THEN 0 WHEN b.electrode < a.electrode THEN 2 * (a.electrode - b.electrode) - 1 ELSE 2 * (b.electrode - a.electrode) END AS ord
  FROM (SELECT DISTINCT user_id AS electrode FROM events) a JOIN (SELECT DISTINCT user_id AS electrode FROM events) b ON abs(a.electrode - b.electrode) <= {reach})"""
PT = """pt AS (SELECT label AS electrode, vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""
D2 = PT + """,
d2 AS (SELECT a.electrode, a.id AS id_a, b.id AS id_b, list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d2 FROM pt a JOIN pt b ON a.electrode = b.electrode)"""
PN = """pn AS (SELECT vec_id // 15 + 2 AS electrode, vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""
N2 = PN + """,
d2 AS (SELECT a.electrode, a.id AS id_a, b.id AS id_b, list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d2 FROM pn a JOIN pn b ON a.electrode = b.electrode)"""
XS = """x AS (SELECT electrode, id, i - 1 AS i, CAST(v[i] AS DOUBLE) AS x FROM (SELECT label AS electrode, vec_id AS id, embedding AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"""
CNT = """cnt AS (SELECT o_custkey - 1 AS id, count(*) AS n FROM orders GROUP BY 1)"""
COMP = N2 + """,
e AS (SELECT electrode, id_a AS u, id_b AS w FROM d2 WHERE d2 > 0 AND d2 < {limit}),
reach AS (SELECT electrode, id, id AS r FROM pn UNION SELECT e.electrode, reach.id, e.w FROM reach JOIN e ON e.electrode = reach.electrode AND e.u = reach.r),
comp AS (SELECT electrode, id, min(r) AS component FROM reach GROUP BY electrode, id)"""
CUT = COMP.format(limit=1.5)
CHANNELS = COMP.format(limit=1.1).replace(N2, D2).replace("FROM pn", "FROM pt")
COMP = COMP.format(limit=1.6)
KEEP = COMP + ", " + CNT + """,
ck AS (SELECT comp.*, coalesce(n, 0) AS n FROM comp LEFT JOIN cnt ON comp.id = cnt.id),
kp AS (SELECT *, first_value(id) OVER (PARTITION BY electrode, component ORDER BY n DESC, id) AS keeper, count(*) OVER (PARTITION BY electrode, component) AS members FROM ck)"""
RECURSIVE = "WITH RECURSIVE "
SCALE = D2 + """,
sc AS (SELECT electrode, id_a AS id, sqrt(d2) AS scale FROM (SELECT *, row_number() OVER (PARTITION BY electrode, id_a ORDER BY d2, id_b) AS nth FROM d2) WHERE nth = 5)"""
TR = """ra AS (SELECT DISTINCT l_suppkey AS electrode, l_linenumber AS ref_id, l_orderkey AS t FROM lineitem),
rb AS (SELECT DISTINCT l_suppkey AS electrode, l_returnflag AS other_id, l_orderkey AS t FROM lineitem),
common AS (SELECT ra.electrode, ref_id, other_id, count(*) AS common FROM ra JOIN rb ON ra.electrode = rb.electrode AND ra.t = rb.t GROUP BY ALL)"""
SCORE = TR + """,
size AS (SELECT electrode, ref_id, count(*) AS size FROM ra GROUP BY ALL),
share AS (SELECT c.electrode, c.ref_id, c.other_id, CAST(common AS DOUBLE) / size AS share FROM common c JOIN size s ON c.electrode = s.electrode AND c.ref_id = s.ref_id),
-- every way to give the up to three flags different line numbers, or none
opt AS (SELECT electrode, ref_id, other_id, share FROM share UNION ALL SELECT electrode, -row_number() OVER (PARTITION BY electrode ORDER BY other_id), other_id, 0.0 FROM (SELECT DISTINCT electrode, other_id FROM share)),
flag AS (SELECT electrode, other_id, row_number() OVER (PARTITION BY electrode ORDER BY other_id) AS k FROM (SELECT DISTINCT electrode, other_id FROM share)),
o AS (SELECT opt.electrode, k, ref_id, share FROM opt JOIN flag ON opt.electrode = flag.electrode AND opt.other_id = flag.other_id),
best AS (SELECT a.electrode, max(a.share + coalesce(b.share, 0) + coalesce(c.share, 0)) AS best FROM (SELECT * FROM o WHERE k = 1) a
  LEFT JOIN (SELECT * FROM o WHERE k = 2) b ON a.electrode = b.electrode AND a.ref_id <> b.ref_id
  LEFT JOIN (SELECT * FROM o WHERE k = 3) c ON a.electrode = c.electrode AND c.ref_id <> a.ref_id AND (b.ref_id IS NULL OR c.ref_id <> b.ref_id) GROUP BY a.electrode),
score AS (SELECT n.electrode, n.n_ref, round(coalesce(best / n_ref, 0), 6) AS score FROM (SELECT electrode, count(DISTINCT ref_id) AS n_ref FROM ra GROUP BY electrode) n LEFT JOIN best ON n.electrode = best.electrode)"""
LI = """c AS (SELECT CAST(l_orderkey % 20 + 1 AS INTEGER) AS id, count(*) AS n FROM lineitem GROUP BY 1)"""
US = """us AS (SELECT user_id AS neuron_id, epoch_us(ts) AS t FROM events)"""
HOURS = """h AS (SELECT user_id AS neuron_id, CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) AS t FROM events),
lags AS (SELECT a.neuron_id, CAST(ceil((b.t - a.t) / 4.0) AS INTEGER) AS bin, count(*) AS n FROM h a JOIN h b ON a.neuron_id = b.neuron_id AND b.t > a.t AND b.t - a.t <= 100 GROUP BY ALL),
every AS (SELECT DISTINCT neuron_id, CAST(bin AS INTEGER) AS bin FROM h, range(1, 26) r(bin)),
acf AS (SELECT every.neuron_id, every.bin, coalesce(n, 0) AS n FROM every LEFT JOIN lags ON every.neuron_id = lags.neuron_id AND every.bin = lags.bin),
share AS (SELECT *, CASE WHEN sum(CAST(n AS DOUBLE) * n) OVER (PARTITION BY neuron_id) > 0 THEN n / sqrt(sum(CAST(n AS DOUBLE) * n) OVER (PARTITION BY neuron_id)) ELSE 0.0 END AS share FROM acf)"""
WEEKS = US + """,
z AS (SELECT neuron_id, t - (SELECT min(t) FROM us) AS t FROM us),
w(dataset, start, stop) AS (VALUES ('w1', 0, 604800000000), ('w2', 604800000000, 1468800000000), ('w3', 1468800000000, 1900800000000))"""
STATUSES = """st AS (SELECT CAST(c_custkey + 1 AS INTEGER) AS neuron_id, CAST(c_custkey * 7 % 6 - 2 AS INTEGER) AS code, CASE WHEN c_custkey * 7 % 6 - 2 >= 2 THEN CAST(c_custkey // 3 + 1 AS INTEGER) END AS master_id FROM customer)"""
LINES = """l(id, label) AS (SELECT CAST(n_nationkey AS INTEGER), CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE n_name END FROM nation WHERE n_nationkey % 4 <> 3)"""
LABEL = """CASE code WHEN 2 THEN 'Merge with ' || master_id WHEN 3 THEN 'Dup. of ID ' || master_id || ', El ' || ((master_id - 1) // 15 + 1)
  WHEN 0 THEN 'Keep' WHEN 1 THEN 'Contam / Low count' WHEN -2 THEN 'Discard' ELSE 'Unknown' END"""


def signed(value: str, digits: int = 6) -> str:
    """Rounded, and 0 for what rounds to minus zero."""
    return f"CASE WHEN round({value}, {digits}) = 0 THEN 0.0 ELSE round({value}, {digits}) END"


def put(name: str, ctes: str, body: str, recursive: bool = False) -> None:
    SQL[name] = (RECURSIVE if recursive else "WITH ") + ctes + "\n" + body if ctes else body


put("spike_detect", CAND, "SELECT electrode, spike_time, width, round(amplitude, 9) AS amplitude FROM sp")
put("stream_detect_equals_batch", CAND, "SELECT electrode, spike_time, width, round(amplitude, 9) AS amplitude FROM sp")
put("spike_candidates", CAND, "SELECT electrode, up, down, width, spike_time, round(amplitude, 9) AS amplitude, gap, kept FROM kept")
put("threshold_crossings", CAND, "SELECT electrode, sample, CASE WHEN hot THEN 'up' ELSE 'down' END AS direction FROM hw WHERE hot <> was")
put("threshold_vector", CH, "SELECT electrode, round(4 * CASE WHEN electrode = 1 THEN 100.0 ELSE stddev_samp(value) END, 6) AS threshold FROM ch GROUP BY electrode")
_rounds = "ch0 AS (SELECT user_id AS electrode, value AS x FROM events), r1 AS (SELECT electrode, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM ch0 GROUP BY electrode)"
for _k in range(2, 6):
    _rounds += f""", m{_k} AS (SELECT electrode, s / n AS mu, sqrt(greatest((q - s * s / n) / (n - 1), 0)) AS sigma FROM r{_k - 1}),
k{_k} AS (SELECT c.electrode, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM ch0 c JOIN m{_k} m ON c.electrode = m.electrode WHERE abs(x - mu) < 3 * sigma GROUP BY c.electrode),
r{_k} AS (SELECT a.electrode, a.n + coalesce(b.n, 0) AS n, a.s + coalesce(b.s, 0) AS s, a.q + coalesce(b.q, 0) AS q FROM r{_k - 1} a LEFT JOIN k{_k} b ON a.electrode = b.electrode)"""
put("noise_floor_k5", _rounds, "SELECT electrode, round(CASE WHEN n > 1 THEN sqrt(greatest((q - s * s / n) / (n - 1), 0)) END, 6) AS sigma, round(s / n, 6) AS mu, n FROM r5")
put("dc_initial_mean", CH, "SELECT electrode, round(avg(value), 6) AS start_mean FROM ch WHERE sample < 10 GROUP BY electrode HAVING count(*) = 10")
put("dc_removal_ema", CH + """,
st AS (SELECT electrode, avg(value) AS m FROM ch WHERE sample < 10 GROUP BY electrode HAVING count(*) = 10),
em AS (SELECT ch.electrode, sample, value, m AS m0 FROM ch JOIN st ON ch.electrode = st.electrode),
rec AS (SELECT electrode, sample, value, 0.8 * m0 + 0.2 * value AS drift FROM em WHERE sample = 0 UNION ALL SELECT e.electrode, e.sample, e.value, 0.8 * r.drift + 0.2 * e.value FROM rec r JOIN em e ON e.electrode = r.electrode AND e.sample = r.sample + 1)""",
    "SELECT electrode, sample, value, round(drift, 6) AS drift, round(value - drift, 6) AS filtered FROM rec", True)
put("ttl_edges", TTL, "SELECT electrode, sample, CAST(1500.0 AS DOUBLE) AS amplitude FROM edges")
put("ttl_intervals", TTL, "SELECT electrode, count(gap) AS n, CAST(sum(gap) AS BIGINT) AS total, round(avg(gap), 6) AS mean FROM (SELECT electrode, sample - lag(sample) OVER (PARTITION BY electrode ORDER BY sample) AS gap FROM edges) WHERE gap IS NOT NULL GROUP BY electrode")
BUF = """ends AS (SELECT electrode, min(sample) AS lo, max(sample) + 1 AS hi FROM ch GROUP BY electrode),
buf AS (SELECT electrode, k AS buffer, greatest(lo, lo + k * 16 - 2) AS start, least(hi, lo + (k + 1) * 16 + 4) AS stop FROM ends, range(0, 100000) r(k) WHERE lo + k * 16 < hi)"""
put("buffered_scan", CH + ", " + BUF, "SELECT b.electrode, buffer, start, stop, count(*) AS n FROM buf b JOIN ch ON ch.electrode = b.electrode AND ch.sample >= start AND ch.sample < stop GROUP BY ALL")
put("spike_buffer_interior", CAND + ", " + BUF, "SELECT sp.electrode, spike_time, buffer, start, stop FROM sp JOIN buf b ON sp.electrode = b.electrode AND spike_time >= start + 2 AND spike_time < stop - 3")
put("time_range_scan", CH, "SELECT electrode, sample, value FROM ch WHERE sample BETWEEN 10 AND 19")
put("electrode_filter_counts", CAND, "SELECT electrode, count(*) AS n FROM sp GROUP BY electrode HAVING count(*) >= 5")
put("noise_event_antijoin", CAND, "SELECT electrode, sample AS spike_time FROM ch WHERE NOT EXISTS (SELECT 1 FROM sp WHERE sp.electrode = ch.electrode AND round(sp.spike_time / 4.0) = round(ch.sample / 4.0))")
put("noise_event_first_only", CAND + """,
nz AS (SELECT electrode, sample AS spike_time, row_number() OVER (PARTITION BY electrode, round(sample / 8.0) ORDER BY sample) AS nth FROM ch)""",
    "SELECT electrode, spike_time FROM nz WHERE nth > 1 OR NOT EXISTS (SELECT 1 FROM sp WHERE sp.electrode = nz.electrode AND round(sp.spike_time / 8.0) = round(nz.spike_time / 8.0))")
put("electrode_adjacency", ADJ.format(reach=3), "SELECT electrode, neighbor, CAST(ord AS INTEGER) AS ord FROM adj")
put("waveform_windows", CAND + ", " + ADJ.format(reach=3), "SELECT sp.electrode, spike_time, neighbor, CAST(ord AS INTEGER) AS ord, CAST(up.sample - spike_time AS INTEGER) AS pos, round(v, 9) AS value FROM sp JOIN adj ON sp.electrode = adj.electrode JOIN up ON up.electrode = neighbor AND up.sample BETWEEN spike_time - 2 AND spike_time + 3")
put("mean_waveform", XS, "SELECT electrode, CAST(i AS INTEGER) AS i, " + signed("avg(x)") + " AS mean, count(*) AS n FROM x GROUP BY electrode, i")
COV = XS + """,
cv AS (SELECT a.electrode, a.i, b.i AS j, count(*) AS n, covar_samp(a.x, b.x) AS cov FROM x a JOIN x b ON a.electrode = b.electrode AND a.id = b.id AND a.i <= b.i GROUP BY ALL)"""
put("covariance_longform", COV, "SELECT electrode, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, n, " + signed("cov") + " AS cov FROM cv")
put("covariance_merge", XS + """,
cv AS (SELECT a.electrode, a.id % 2 AS part, a.i, b.i AS j, count(*) AS n, covar_samp(a.x, b.x) AS cov FROM x a JOIN x b ON a.electrode = b.electrode AND a.id = b.id AND a.i <= b.i GROUP BY ALL)""",
    "SELECT electrode, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CAST(sum(n) AS BIGINT) AS n, " + signed("sum(n * cov) / sum(n)") + " AS cov FROM cv GROUP BY electrode, i, j")
put("pc_project_fixed_basis", XS + """,
mn AS (SELECT electrode, i, avg(x) AS m FROM x GROUP BY electrode, i),
ax(rank, i, a) AS (VALUES (1,0,1.0),(1,1,0.5),(1,2,-0.5),(1,3,0.25),(1,4,0.0),(1,5,0.0),(1,6,1.0),(1,7,-1.0),(2,0,0.0),(2,1,1.0),(2,2,1.0),(2,3,-1.0),(2,4,0.5),(2,5,-0.5),(2,6,0.0),(2,7,0.25))""",
    "SELECT x.electrode, id, ax.rank, " + signed("sum((x - m) * CAST(a AS DOUBLE))") + " AS score FROM x JOIN mn ON x.electrode = mn.electrode AND x.i = mn.i JOIN ax ON ax.i = x.i % 8 GROUP BY x.electrode, id, ax.rank")
put("l2_normalize", XS, "SELECT id, CAST(i AS INTEGER) AS i, " + signed("x / sqrt(sum(x * x) OVER (PARTITION BY id))") + " AS x FROM x")
put("pairwise_l2", N2, "SELECT CAST(electrode AS INTEGER) AS electrode, id_a, id_b, round(d2, 6) AS d2 FROM d2 WHERE id_a < id_b")
put("pairwise_l2_channels", D2, "SELECT electrode, id_a, id_b, round(d2, 6) AS d2 FROM d2 WHERE id_a < id_b")
put("merge_components_channels", CHANNELS, "SELECT electrode, id, component FROM comp", True)
put("neighbor_pairs_l2", PN, "SELECT CAST(a.electrode AS INTEGER) AS ea, CAST(b.electrode AS INTEGER) AS eb, a.id AS id_a, b.id AS id_b, round(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 6) AS d2 FROM pn a JOIN pn b ON b.electrode = a.electrode + 1")
put("nth_neighbor_scale", SCALE, "SELECT electrode, id, round(scale, 6) AS scale FROM sc")
AFF = SCALE + ", af AS (SELECT d2.electrode, id_a, id_b, d2, a.scale AS sa, b.scale AS sb FROM d2 JOIN sc a ON a.electrode = d2.electrode AND a.id = id_a JOIN sc b ON b.electrode = d2.electrode AND b.id = id_b)"
put("local_affinity", AFF, "SELECT electrode, id_a, id_b, round(exp(-d2 / (sa * sb)), 6) AS a FROM af")
put("power_affinity", AFF, "SELECT electrode, id_a, id_b, round(1 / (1 + d2 * sa * sb), 6) AS a FROM af WHERE 1 / (1 + d2 * sa * sb) >= 0.2")
put("cluster_stats", XS, "SELECT electrode, CAST(id % 3 AS INTEGER) AS clust, CAST(i AS INTEGER) AS i, " + signed("avg(x)") + " AS centroid, round(var_pop(x), 6) AS variance, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY electrode, i) AS DOUBLE), 6) AS mix_frac FROM x GROUP BY electrode, id % 3, i")
put("nearest_centroid", XS + """,
ce AS (SELECT electrode, id % 3 AS clust, i, avg(x) AS c FROM x GROUP BY ALL),
ds AS (SELECT x.electrode, x.id, clust, sum((x - c) * (x - c)) AS d2 FROM x JOIN ce ON x.electrode = ce.electrode AND x.i = ce.i GROUP BY ALL)""",
    "SELECT electrode, id, CAST(clust AS INTEGER) AS clust, round(d2, 6) AS d2 FROM (SELECT *, row_number() OVER (PARTITION BY electrode, id ORDER BY d2, clust) AS nth FROM ds) WHERE nth = 1")
RANK = SCALE + ", rk AS (SELECT electrode, id, row_number() OVER (PARTITION BY electrode ORDER BY round(scale, 9), id) AS rank, count(*) OVER (PARTITION BY electrode) AS n FROM sc)"
put("knn_distance_rank", RANK, "SELECT electrode, id, CAST(rank AS INTEGER) AS rank FROM rk")
put("shrink_prefix", RANK, "SELECT electrode, id, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= floor(0.6 * n)")
put("merge_components", COMP, "SELECT CAST(electrode AS INTEGER) AS electrode, id, component FROM comp", True)
put("final_forest", COMP, "SELECT CAST(electrode AS INTEGER) AS electrode, component, count(*) AS members FROM comp GROUP BY electrode, component HAVING count(*) > 1", True)
put("component_keeper", KEEP, "SELECT CAST(electrode AS INTEGER) AS electrode, id, component, n, keeper FROM kp", True)
put("auto_merge_actions", KEEP, "SELECT CAST(electrode AS INTEGER) AS electrode, 'AUTO_MERGE' AS action, keeper AS master_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM kp WHERE members > 1 AND id <> keeper GROUP BY electrode, keeper", True)
GLOB = PT + ", " + CNT + """,
d AS (SELECT a.electrode AS ea, b.electrode AS eb, a.id AS u, b.id AS w FROM pt a JOIN pt b ON a.id <> b.id WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) < 1.1 AND list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) > 0),
cb AS (SELECT DISTINCT x.electrode AS e1, y.electrode AS e2 FROM pt x JOIN (SELECT DISTINCT electrode FROM pt) y ON x.electrode < y.electrode),
e AS (SELECT e1 || '-' || e2 AS pair, u, w FROM d JOIN cb ON ea IN (e1, e2) AND eb IN (e1, e2)),
reach AS (SELECT pair, u AS id, u AS r FROM e UNION SELECT e.pair, reach.id, e.w FROM reach JOIN e ON e.pair = reach.pair AND e.u = reach.r),
comp AS (SELECT pair, id, min(r) AS component FROM reach GROUP BY pair, id),
kp AS (SELECT comp.*, first_value(comp.id) OVER (PARTITION BY pair, component ORDER BY coalesce(n, 0) DESC, comp.id) AS keeper FROM comp LEFT JOIN cnt ON comp.id = cnt.id),
dup AS (SELECT pair, keeper AS master_id, id AS loser_id FROM kp WHERE id <> keeper)"""
put("global_duplicate_pairs", GLOB, "SELECT pair, master_id, loser_id FROM dup", True)
put("duplicates_by_master", GLOB, "SELECT master_id, string_agg(CAST(loser_id AS VARCHAR), ',' ORDER BY loser_id) AS ids FROM (SELECT DISTINCT master_id, loser_id FROM dup) GROUP BY master_id", True)
put("shorten_duplicate_chains", """l AS (SELECT CAST(c_custkey // 2 AS INTEGER) AS m, CAST(c_custkey AS INTEGER) AS x FROM customer WHERE c_custkey % 3 <> 0),
up AS (SELECT m, x FROM l UNION SELECT l.m, up.x FROM up JOIN l ON l.x = up.m)""",
    "SELECT m AS master_id, x AS loser_id FROM up WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.x = up.m)", True)
put("id_codec", "", "SELECT CAST(s_suppkey + 1 AS INTEGER) AS electrode, CAST(c AS INTEGER) AS clust, CAST((s_suppkey - 1) * 15 + c AS INTEGER) AS neuron_id, CAST(s_suppkey + 1 AS INTEGER) AS back_electrode, CAST(c AS INTEGER) AS back_clust FROM supplier, range(1, 16) r(c)")
put("status_labels", STATUSES, f"SELECT neuron_id, {LABEL} AS label FROM st")
put("status_summary", "", "SELECT CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE -1 END AS code, count(*) AS n FROM orders GROUP BY 1")
put("default_visible", STATUSES, "SELECT neuron_id, code FROM st WHERE code NOT IN (1, -2)")
put("colour_ranks", STATUSES, "SELECT neuron_id, round((row_number() OVER (PARTITION BY floor((neuron_id - 1) / 15.0) ORDER BY coalesce(master_id, neuron_id), neuron_id) - 1) / CAST(count(*) OVER (PARTITION BY floor((neuron_id - 1) / 15.0)) AS DOUBLE), 6) AS hue FROM st")
put("pretty_print", "", "SELECT n_nationkey, '[' || n_nationkey || ' ' || CASE WHEN n_nationkey % 8 = 0 THEN CAST(n_nationkey // 8 AS VARCHAR) ELSE printf('%.2f', n_nationkey / 8.0) END || ' ' || n_regionkey || ']' AS said FROM nation")
put("cluster_report", STATUSES + """,
o AS (SELECT CAST(o_custkey AS INTEGER) AS neuron_id, o_orderkey AS t FROM orders),
g AS (SELECT neuron_id, t - lag(t) OVER (PARTITION BY neuron_id ORDER BY t) AS gap FROM o),
n AS (SELECT neuron_id, count(*) AS n_spikes, count(*) FILTER (gap > 0 AND gap <= 500) AS bad FROM g GROUP BY neuron_id),
j AS (SELECT n.neuron_id, n_spikes, bad, coalesce(code, 0) AS code, master_id FROM n LEFT JOIN st ON n.neuron_id = st.neuron_id),
""" + LINES,
    f"""SELECT neuron_id, round((row_number() OVER (PARTITION BY floor((neuron_id - 1) / 15.0) ORDER BY coalesce(master_id, neuron_id), neuron_id) - 1) / CAST(count(*) OVER (PARTITION BY floor((neuron_id - 1) / 15.0)) AS DOUBLE), 6) AS hue,
  code NOT IN (1, -2) AS displayed, {LABEL} AS status, n_spikes, round(n_spikes * 20000.0 / 36000000.0, 6) AS hz,
  round(CASE WHEN n_spikes < 2 THEN 0.0 ELSE bad * 36000000.0 / (500.0 * n_spikes * n_spikes) END, 6) AS contamination, label FROM j LEFT JOIN l ON l.id = neuron_id""")  # fmt: skip
CON = US + """,
g AS (SELECT neuron_id, t - lag(t) OVER (PARTITION BY neuron_id ORDER BY t) AS gap FROM us),
v AS (SELECT neuron_id, count(*) AS n, count(*) FILTER (gap > 0 AND gap <= 3600000000) AS violations FROM g GROUP BY neuron_id),
con AS (SELECT *, round(CASE WHEN n < 2 THEN 0.0 ELSE violations / (3600000000.0 * n * n) * (SELECT CAST(max(t) - min(t) AS DOUBLE) FROM us) END, 6) AS contamination FROM v)"""
put("contamination", CON, "SELECT neuron_id, n, violations, contamination FROM con")
put("clean_filter", CON, "SELECT neuron_id, n, n < 60 OR contamination > 1.0 AS removed FROM con")
BIG = "(SELECT id FROM c WHERE id IN ({a}, {b}) ORDER BY n DESC, id LIMIT 1)"
put("apply_auto_actions", LI, f"SELECT CAST(CASE WHEN id IN (1, 5) THEN 3 WHEN id IN (7, 8) THEN {BIG.format(a=7, b=8)} ELSE id END AS INTEGER) AS neuron_id, CAST(sum(n) AS BIGINT) AS n FROM c WHERE id NOT IN (2, 17, 4) GROUP BY 1")
put("apply_manual_actions", LI, f"SELECT CAST(CASE WHEN id IN (1, 2) THEN {BIG.format(a=1, b=2)} WHEN id IN (5, 7) THEN {BIG.format(a=5, b=7)} ELSE id END AS INTEGER) AS neuron_id, CAST(sum(n) AS BIGINT) AS n FROM c WHERE id <> 4 GROUP BY 1")
put("incremental_actions", LI, f"SELECT CAST(CASE WHEN id IN (5, 7) THEN {BIG.format(a=5, b=7)} ELSE id END AS INTEGER) AS neuron_id, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY 1")
put("auto_dry_run", LI + f", m AS (SELECT {BIG.format(a=7, b=8)} AS k)", """SELECT id AS neuron_id, CASE WHEN id = 2 THEN 1 WHEN id IN (1, 5) THEN 2 WHEN id IN (17, 4) THEN 3 WHEN id IN (7, 8) AND id <> k THEN 2 ELSE 0 END AS code,
  CASE WHEN id IN (1, 5, 17, 4) THEN 3 WHEN id IN (7, 8) AND id <> k THEN k END AS master_id FROM c, m""")
LOG = """lg AS (SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 1000 = 0 THEN 'CONSOLIDATE' WHEN o_orderkey % 3 = 0 THEN 'KEEP' WHEN o_orderkey % 3 = 1 THEN 'DELETE' ELSE 'MERGE' END AS action,
  CASE WHEN o_orderkey % 1000 = 0 THEN [] ELSE [o_custkey, o_custkey + 7] END AS ids FROM orders)"""
put("actions_since_consolidate", LOG, "SELECT seq, action, array_to_string(ids, ',') AS ids FROM lg WHERE seq > (SELECT coalesce(max(seq), -1) FROM lg WHERE action = 'CONSOLIDATE')")
put("actions_of_electrode", LOG, "SELECT seq, action FROM lg WHERE len(list_filter(ids, lambda x: x BETWEEN 16 AND 30)) > 0")
put("missing_ids", "", "SELECT CAST(id AS BIGINT) AS neuron_id FROM (VALUES (1), (5), (1000000000)) a(id) WHERE id NOT IN (SELECT c_custkey FROM customer)")
put("split_by_interval", WEEKS, "SELECT dataset, neuron_id, t - start AS spike_time FROM z JOIN w ON t >= start AND t < stop")
put("concat_offsets", WEEKS, "SELECT dataset, neuron_id, t AS spike_time FROM z JOIN w ON t >= start AND t < stop")
put("dataset_strings", "n AS (SELECT n_nationkey AS k, regexp_replace(lower(n_name), '[^a-z0-9]', '_', 'g') || '.bin' AS path FROM nation)",
    "SELECT path, CAST(CASE WHEN k % 4 IN (0, 1) THEN k ELSE 0 END AS DOUBLE) AS start, CASE k % 4 WHEN 0 THEN CAST(k + 10 AS DOUBLE) WHEN 2 THEN k + CAST(0.5 AS DOUBLE) END AS stop FROM n")
put("classification_labels", LINES, "SELECT id AS neuron_id, label FROM l")
put("label_join", LINES, "SELECT n_nationkey AS neuron_id, label FROM nation LEFT JOIN l ON id = n_nationkey")
put("export_models", "p AS (SELECT label AS electrode, CAST(vec_id % 2 + 1 AS INTEGER) AS clust, count(*) AS n, max(len(embedding)) AS dims FROM embeddings GROUP BY ALL), s AS (SELECT *, n / CAST(sum(n) OVER (PARTITION BY electrode) AS DOUBLE) AS f FROM p), e AS (SELECT CAST(e AS INTEGER) AS e FROM range(0, 14) r(e) UNION SELECT electrode FROM p)",
    "SELECT e AS electrode, coalesce(clust, 1) AS clust, CAST(coalesce(dims, 1) AS INTEGER) AS dims, round(coalesce(f, 0.0), 6) AS mix_frac FROM e LEFT JOIN s ON s.electrode = e")
put("export_neurons", CAND, "SELECT CAST(electrode * 15 + width % 3 AS INTEGER) AS neuron_id, CAST(electrode + 2 AS INTEGER) AS electrode, spike_time - 5 AS spike_time FROM sp WHERE width % 3 > 0")
put("export_spikes", CAND, "SELECT CAST(spike_time AS INTEGER) AS spike_time, CAST(electrode - 1 AS INTEGER) AS electrode FROM sp")
put("train_intersections", TR, "SELECT electrode, ref_id, other_id, common FROM common")
put("comparator_score", SCORE, "SELECT electrode, n_ref, score FROM score")
put("comparator_summary", SCORE, "SELECT CAST(electrode % 5 AS INTEGER) AS dataset, count(*) AS n, round(avg(score), 9) AS mean, round(stddev_samp(score), 9) AS std, round(avg(score) FILTER (score > 0), 9) AS mean_nonzero, round(stddev_samp(score) FILTER (score > 0), 9) AS std_nonzero FROM score GROUP BY ROLLUP (CAST(electrode % 5 AS INTEGER))")
put("train_correlation", "m AS (SELECT user_id AS id, CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) AS t FROM events), s AS (SELECT id, count(*) AS n FROM m GROUP BY id), h AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS n FROM m a JOIN m b ON a.id < b.id AND a.t BETWEEN b.t - 10 AND b.t + 10 GROUP BY ALL)",
    "SELECT id_a, id_b, h.n, round(h.n / sqrt(CAST(x.n AS DOUBLE) * y.n), 6) AS corr FROM h JOIN s x ON x.id = id_a JOIN s y ON y.id = id_b")
put("rate_histogram", US + ", en AS (SELECT neuron_id, min(t) AS lo, max(t) AS hi FROM us GROUP BY neuron_id)",
    "SELECT us.neuron_id, CAST(CASE WHEN hi > lo THEN least(floor((t - lo) * 20 / CAST(hi - lo AS DOUBLE)) + 1, 20) ELSE 1 END AS INTEGER) AS bin, count(*) AS n FROM us JOIN en ON us.neuron_id = en.neuron_id GROUP BY ALL")
put("autocorrelogram", HOURS, "SELECT neuron_id, bin, n, round(share, 6) AS share FROM share")
put("acf_smoothed", HOURS, "SELECT neuron_id, bin, round(sum(share) OVER (PARTITION BY neuron_id ORDER BY bin ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) / 8, 6) AS smooth FROM share")
put("compound_ei", XS + ", " + CNT, "SELECT electrode, CAST(i AS INTEGER) AS i, CAST(sum(n) AS BIGINT) AS n, " + signed("sum(n * x) / sum(n)") + " AS x FROM x JOIN cnt ON x.id = cnt.id GROUP BY electrode, i")
STRIDE = CAND + """,
pl AS (SELECT electrode AS neuron_id, spike_time, row_number() OVER (PARTITION BY electrode ORDER BY spike_time) - 1 AS i, count(*) OVER (PARTITION BY electrode) // 3 AS step FROM sp),
sd AS (SELECT neuron_id, spike_time FROM pl WHERE step = 0 OR (i > 0 AND i % CASE WHEN step = 0 THEN 1 ELSE step END = 0)
  OR (i = 0 AND (spike_time, neuron_id) = (SELECT (spike_time, neuron_id) FROM pl ORDER BY spike_time, neuron_id LIMIT 1)))"""
put("ei_stride_sample", STRIDE, "SELECT neuron_id, spike_time FROM sd")
put("ei_average", STRIDE + ", " + ADJ.format(reach=2), "SELECT neuron_id, up.electrode, CAST(up.sample - spike_time AS INTEGER) AS pos, count(*) AS n, round(avg(v), 9) AS mean FROM sd JOIN adj ON adj.electrode = neuron_id JOIN up ON up.electrode = adj.neighbor AND up.sample BETWEEN spike_time - 2 AND spike_time + 6 GROUP BY ALL")
put("asof_trigger", CAND + ", tt AS (SELECT *, coalesce(lag(event_type = 'error') OVER (PARTITION BY electrode ORDER BY sample), FALSE) AS was_error FROM ch), tg AS (SELECT electrode, sample AS trigger_time FROM tt WHERE event_type = 'error' AND NOT was_error)",
    "SELECT sp.electrode, spike_time, trigger_time FROM sp ASOF LEFT JOIN tg ON sp.electrode = tg.electrode AND spike_time >= trigger_time")
put("sta_average", CAND + ", fm AS (SELECT sample // 2 AS frame, avg(value) AS value FROM ch GROUP BY 1)",
    "SELECT electrode AS neuron_id, CAST(back AS INTEGER) AS back, count(*) AS n, round(avg(fm.value), 9) AS mean FROM sp, range(0, 5) r(back) JOIN fm ON fm.frame = sp.spike_time // 2 - 1 - back GROUP BY ALL")
put("sta_frames", CAND, "SELECT electrode AS neuron_id, CAST(back AS INTEGER) AS back, count(*) AS n, CAST(k - 1 AS INTEGER) AS i, round(avg(CAST(embedding[k] AS DOUBLE)), 7) AS mean FROM sp, range(0, 30) r(back) JOIN embeddings ON vec_id = sp.spike_time - 1 - back, range(1, 65) c(k) GROUP BY electrode, back, k")
put("recording_electrodes", CH, "SELECT electrode, sample, value FROM ch WHERE electrode IN (3, 8) AND sample >= 20")
put("recording_stream", CH, "SELECT electrode, count(*) AS n, count(DISTINCT sample) AS samples, round(sum(value), 4) AS total FROM ch GROUP BY electrode")
put("noise_table", CH, "SELECT CAST(electrode AS INTEGER) AS electrode, round(CASE WHEN electrode = 1 THEN 0.0 ELSE stddev_samp(value) END, 6) AS sigma FROM ch GROUP BY electrode")
put("projections_reader", "", "SELECT l_suppkey AS electrode, l_orderkey AS spike_time, CAST(min(l_quantity) AS DOUBLE) AS pc1, CAST(max(l_discount) AS DOUBLE) AS pc2 FROM lineitem WHERE l_quantity > 10 GROUP BY l_suppkey, l_orderkey")
put("whitened_identity", "", "SELECT electrode, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cov FROM (SELECT DISTINCT label AS electrode FROM embeddings), range(0, 8) a(i), range(0, 8) b(j) WHERE i <= j")
put("action_checks", """a AS (SELECT o_orderkey AS k, o_custkey AS c, ['KEEP', 'MERGE', 'SHRINK', 'RECLUSTER', 'AUTO_MERGE', 'RENAME', 'CONSOLIDATE'][o_orderkey % 7 + 1] AS action FROM orders),
b AS (SELECT *, k % 5 = 0 AS none, k % 5 = 1 AS twice, CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN c ELSE c - 2 END AS low, (k % 11) / 8.0 AS frac, CASE WHEN k % 13 > 0 THEN k % 4 - 1 END AS contam, k % 19 - 1 AS clusters FROM a)""",
    """SELECT k AS seq, action, CASE WHEN action = 'RENAME' THEN 'unknown action RENAME' WHEN none AND action <> 'CONSOLIDATE' AND action <> 'AUTO_MERGE' THEN action || ' needs ids' WHEN action = 'SHRINK' AND contam IS NULL THEN 'SHRINK needs contam'
  WHEN action = 'RECLUSTER' AND k % 2 = 1 THEN 'RECLUSTER needs config_tag' WHEN action = 'AUTO_MERGE' AND k % 3 = 0 THEN 'AUTO_MERGE needs master_id' WHEN action = 'AUTO_MERGE' AND none THEN 'AUTO_MERGE needs ids'
  WHEN action = 'MERGE' AND twice THEN 'MERGE needs two ids or more' WHEN low < 1 THEN 'ids are whole numbers from 1' WHEN frac <= 0 OR frac > 1 THEN 'frac lies in (0, 1]' WHEN contam < 0 THEN 'contam is not negative'
  WHEN clusters < 0 OR clusters > 15 THEN 'n_clusters lies in 0..15, 0 for the automatic choice' END AS wrong FROM b""")  # fmt: skip
put("electrode_pools", "n AS (SELECT count(*) AS n FROM supplier), e AS (SELECT i, CAST(floor(n * i / 12.0 + 0.5) AS BIGINT) + 1 AS edge FROM n, range(0, 13) r(i))", "SELECT CAST(i AS BIGINT) AS pool, lag(edge) OVER (ORDER BY i) AS first, edge - 1 AS last FROM e QUALIFY i > 0")
put("set_operations", "a AS (SELECT c_nationkey AS k FROM customer), b AS (SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 0)",
    "SELECT 'both' AS kind, k FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'left', k FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'any', k FROM (SELECT k FROM a UNION SELECT k FROM b)")
put("final_or_raw", "", "SELECT p_partkey, round(CASE WHEN p_size > 25 THEN p_retailprice * 2 ELSE p_retailprice END, 6) AS x FROM part")


UPF = CH + """,
lim AS (SELECT electrode, avg(value) AS mu, stddev_samp(value) AS threshold FROM ch GROUP BY electrode),
raw AS (SELECT ch.electrode, ch.sample, mu - ch.value AS v, threshold FROM ch JOIN lim ON ch.electrode = lim.electrode),
em AS (SELECT electrode, sample, threshold, v AS drift, CAST(0.0 AS DOUBLE) AS f FROM raw WHERE sample = 0 UNION ALL
  SELECT r.electrode, r.sample, r.threshold, 0.8 * e.drift + 0.2 * r.v, r.v - (0.8 * e.drift + 0.2 * r.v) FROM em e JOIN raw r ON r.electrode = e.electrode AND r.sample = e.sample + 1),
up AS (SELECT electrode, sample, f AS v, threshold FROM em)"""
put("stream_filtered_detect", UPF + CAND[len(UP) :], "SELECT electrode, spike_time, width, round(amplitude, 9) AS amplitude FROM sp", True)

# ------------------------------------------------------------------------------------- images, edits, stage tables

put("noise_floor_converged", """ch0 AS (SELECT user_id AS electrode, CAST(value AS DOUBLE) AS x FROM events),
base AS (SELECT electrode, CAST(count(*) AS DOUBLE) AS n, sum(x) AS s, sum(x * x) AS q FROM ch0 GROUP BY electrode),
rec AS (
  SELECT electrode, 1 AS rounds, n, s, q, s / n AS mu, sqrt(greatest((q - s * s / n) / greatest(n - 1, 1), 0)) AS sigma, CAST(1e300 AS DOUBLE) AS last FROM base
  UNION ALL
  SELECT electrode, rounds, n, s, q, s / n, sqrt(greatest((q - s * s / n) / greatest(n - 1, 1), 0)), sigma FROM (
    SELECT r.electrode, r.rounds + 1 AS rounds, r.n + coalesce(k.n, 0) AS n, r.s + coalesce(k.s, 0) AS s, r.q + coalesce(k.q, 0) AS q, r.sigma FROM rec r LEFT JOIN (
      SELECT c.electrode, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM ch0 c JOIN rec m ON c.electrode = m.electrode WHERE abs(x - m.mu) < 3 * m.sigma GROUP BY c.electrode
    ) k ON k.electrode = r.electrode WHERE abs(r.last - r.sigma) >= 0.01 AND r.rounds < 1000
  )
)""", "SELECT electrode, round(arg_max(sigma, rounds), 6) AS sigma, round(arg_max(mu, rounds), 6) AS mu, CAST(max(rounds) AS INTEGER) AS rounds, CAST(arg_max(n, rounds) AS BIGINT) AS n FROM rec GROUP BY electrode", True)  # fmt: skip
HASH = "CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT)"
# four rounds of a Feistel network over the smallest square of a power of two, again while the number lies outside the span
put("random_noise_events", CH + """,
sp AS (SELECT electrode, min(sample) AS first, count(*) AS span, CAST(round(count(*) * 0.2) AS BIGINT) AS n FROM ch GROUP BY electrode),
hf AS (SELECT *, (SELECT min(CAST(pow(2, k) AS BIGINT)) FROM range(0, 32) t(k) WHERE pow(4, k) >= span) AS half FROM sp WHERE n > 0),
walk AS (
  SELECT electrode, first, span, n, i, half, i AS x, 0 AS pass FROM (SELECT *, unnest(range(0, n)) AS i FROM hf)
  UNION ALL SELECT electrode, first, span, n, i, half, a * half + b AS x, pass + 1 FROM (
    WITH r0 AS (SELECT electrode, first, span, n, i, half, x // half AS a, x % half AS b, pass FROM walk WHERE pass = 0 OR x >= span),
    r1 AS (SELECT * REPLACE (b AS a, xor(a, """ + HASH.format(key="'0|' || electrode || '|1|' || b") + """ % half) AS b) FROM r0),
    r2 AS (SELECT * REPLACE (b AS a, xor(a, """ + HASH.format(key="'0|' || electrode || '|2|' || b") + """ % half) AS b) FROM r1),
    r3 AS (SELECT * REPLACE (b AS a, xor(a, """ + HASH.format(key="'0|' || electrode || '|3|' || b") + """ % half) AS b) FROM r2),
    r4 AS (SELECT * REPLACE (b AS a, xor(a, """ + HASH.format(key="'0|' || electrode || '|4|' || b") + """ % half) AS b) FROM r3)
    SELECT * FROM r4)
)""", "SELECT electrode, first + x AS spike_time FROM walk WHERE pass > 0 AND x < span", True)
put("display_sample", PT + """,
d AS (SELECT electrode, CAST(id % 3 AS INTEGER) AS clust, id, count(*) OVER (PARTITION BY electrode) AS total, count(*) OVER (PARTITION BY electrode, id % 3) AS n,
  row_number() OVER (PARTITION BY electrode, id % 3 ORDER BY """ + HASH.format(key="'0|' || id") + """, id) AS nth FROM pt)""", "SELECT electrode, clust, id FROM d WHERE nth <= floor(least(1.0, CAST(30 AS DOUBLE) / total) * n)")  # fmt: skip
put("spikes_in_order", CAND, "SELECT row_number() OVER (ORDER BY spike_time, electrode) - 1 AS place, spike_time, electrode FROM sp")
put("eigen_invariants", COV, "SELECT electrode, round(sum(CASE WHEN i = j THEN cov ELSE 0 END), 6) AS trace, round(sum(CASE WHEN i = j THEN cov * cov ELSE 2 * cov * cov END), 6) AS squares FROM cv GROUP BY electrode")
put("pc_energy", XS + ", mn AS (SELECT electrode, i, avg(x) AS m FROM x GROUP BY electrode, i)", "SELECT x.electrode, id, round(sum((x - m) * (x - m)), 6) AS energy FROM x JOIN mn ON x.electrode = mn.electrode AND x.i = mn.i GROUP BY x.electrode, id")
put("dendrogram_cut", CUT, "SELECT CAST(electrode AS INTEGER) AS electrode, id, component FROM comp", True)
put("dendrogram_sizes", COMP + ", sz AS (SELECT electrode, component, count(*) AS k FROM comp GROUP BY electrode, component HAVING count(*) > 1)", "SELECT CAST(electrode AS INTEGER) AS electrode, CAST(sum(k - 1) AS BIGINT) AS merges, max(k) AS largest FROM sz GROUP BY electrode", True)
put("edit_log", "lg(seq, action, ids) AS (VALUES (1, 'KEEP', '16'), (2, 'MERGE', '1,2'), (3, 'DELETE', '4'), (4, 'CONSOLIDATE', ''), (5, 'MERGE', '5,7'), (6, 'CONSOLIDATE', ''))", "SELECT * FROM lg")
put("consolidated_neurons", LI + f""", t AS (SELECT CAST(l_orderkey % 20 + 1 AS INTEGER) AS id, l_orderkey * 8 + l_linenumber AS t FROM lineitem)""",
    f"SELECT CAST(CASE WHEN id IN (1, 2) THEN {BIG.format(a=1, b=2)} WHEN id IN (5, 7) THEN {BIG.format(a=5, b=7)} ELSE id END AS INTEGER) AS neuron_id, count(*) AS n, min(t) AS first, max(t) AS last FROM t WHERE id <> 4 GROUP BY 1")
put("replay_trains", """r AS (SELECT l_orderkey % 20 + 1 AS id, l_orderkey * 8 + l_linenumber AS t, l_linenumber AS line FROM lineitem),
m AS (SELECT CASE WHEN id = 3 THEN CASE WHEN line <= 4 THEN 3 ELSE 21 END WHEN id IN (6, 9) THEN CASE WHEN line % 2 = 1 THEN 6 ELSE 22 END ELSE id END AS id, t, line FROM r),
k AS (SELECT id FROM m WHERE id IN (1, 6) GROUP BY id ORDER BY count(*) DESC, id LIMIT 1)""",
    "SELECT CAST(CASE WHEN m.id IN (1, 6) THEN k.id ELSE m.id END AS INTEGER) AS neuron_id, count(*) AS n, CAST(sum(t) AS BIGINT) AS total, max(line) AS line FROM m, k WHERE m.id NOT IN (21, 8) GROUP BY 1")
put("merged_trains", "", "SELECT CASE WHEN o_custkey % 10 = 1 THEN o_custkey - 1 ELSE o_custkey END AS neuron_id, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS times FROM orders GROUP BY 1")
ST = """t AS (SELECT DISTINCT l_suppkey AS electrode, CAST(l_linenumber AS INTEGER) AS neuron_id, l_orderkey AS spike_time FROM lineitem),
p AS (SELECT l_suppkey AS electrode, l_orderkey AS spike_time, CAST(min(l_quantity) AS DOUBLE) AS pc1, CAST(max(l_discount) AS DOUBLE) AS pc2 FROM lineitem WHERE l_quantity > 10 GROUP BY ALL),
tp AS (SELECT t.electrode, neuron_id, t.spike_time, pc1, pc2 FROM t JOIN p ON t.electrode = p.electrode AND t.spike_time = p.spike_time)"""
put("train_projections", ST, "SELECT electrode, neuron_id, spike_time, pc1, pc2 FROM tp")
put("preview_electrode", ST + """,
o AS (SELECT * FROM tp WHERE electrode = 3),
big AS (SELECT neuron_id FROM o WHERE neuron_id IN (1, 2) GROUP BY neuron_id ORDER BY count(*) DESC, neuron_id LIMIT 1),
m AS (SELECT CASE WHEN o.neuron_id IN (1, 2) THEN big.neuron_id WHEN o.neuron_id IN (3, 4) THEN CASE WHEN pc1 > 30 THEN 3 ELSE 4 END ELSE o.neuron_id END AS neuron_id, spike_time, CASE WHEN o.neuron_id = 7 THEN -2 ELSE 0 END AS status FROM o, big),
g AS (SELECT *, spike_time - lag(spike_time) OVER (PARTITION BY neuron_id ORDER BY spike_time) AS gap FROM m)""",
    "SELECT CAST(neuron_id AS INTEGER) AS neuron_id, count(*) AS n, round(CASE WHEN count(*) < 2 THEN 0.0 ELSE count(*) FILTER (gap > 0 AND gap <= 500) * 1000000.0 / (500.0 * count(*) * count(*)) END, 6) AS contamination, CAST(max(status) AS INTEGER) AS status FROM g GROUP BY neuron_id")
# a neuron's image: eight samples on the electrodes home - 4 .. home + 3; its trace over electrodes lo..hi is one slice
TRACE = PN + """,
el AS (SELECT DISTINCT electrode AS e FROM pn), pr AS (SELECT a.e AS e1, b.e AS e2, a.e + {lo} AS lo, a.e + {hi} AS hi FROM el a JOIN el b ON b.e = a.e + 1),
tq AS MATERIALIZED (SELECT e1 || '-' || e2 AS pair, electrode, id, v[CAST(8 * (lo - electrode + 4) + 1 AS INTEGER):CAST(8 * (hi - electrode + 5) AS INTEGER)] AS t FROM pr JOIN pn ON electrode IN (e1, e2)),
tn AS MATERIALIZED (SELECT *, sqrt(list_inner_product(t, t)) AS size FROM tq), tr AS MATERIALIZED (SELECT pair, electrode, id, list_transform(t, lambda y: y / size) AS t FROM tn)"""
PAIRS = ", pd AS (SELECT a.pair, a.id AS id_a, b.id AS id_b, list_distance(a.t, b.t) * list_distance(a.t, b.t) AS d2 FROM tr a JOIN tr b ON a.pair = b.pair AND a.id < b.id)"
for _name, _lo, _hi in (("traces_union", -1, 2), ("traces_intersection", 0, 1)):
    put(_name, TRACE.format(lo=_lo, hi=_hi) + PAIRS, "SELECT pair, id_a, id_b, round(d2, 6) AS d2 FROM pd")
put("neighbourhood_sets", PN + ", el AS (SELECT DISTINCT electrode AS e FROM pn), p AS (SELECT a.e AS e1, b.e AS e2 FROM el a JOIN el b ON b.e > a.e AND b.e - a.e <= 10)",
    """SELECT CAST(e1 AS INTEGER) AS e1, CAST(e2 AS INTEGER) AS e2, o AS over, CASE WHEN o = 'union' THEN array_to_string(list_sort(list_distinct([e1 - 1, e1, e1 + 1, e2 - 1, e2, e2 + 1])), ',')
  ELSE array_to_string(list_filter([e1 - 1, e1, e1 + 1], lambda x: x BETWEEN e2 - 1 AND e2 + 1), ',') END AS electrodes FROM p, (VALUES ('union'), ('intersection')) v(o)""")  # fmt: skip
WITHIN = PN + """,
wt AS (SELECT electrode, id, v[25:48] AS t FROM pn), wn AS (SELECT electrode, id, list_transform(t, lambda y: y / sqrt(list_sum(list_transform(t, lambda x: x * x)))) AS t FROM wt),
we AS (SELECT a.electrode, a.id AS u, b.id AS w FROM wn a JOIN wn b ON a.electrode = b.electrode AND a.id <> b.id WHERE list_sum(list_transform(list_zip(a.t, b.t), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) < 1.1),"""
put("merge_by_images", WITHIN + """
reach AS (SELECT id, id AS r FROM pn UNION SELECT reach.id, we.w FROM reach JOIN we ON we.u = reach.r),
comp AS (SELECT electrode, reach.id, min(r) AS component FROM reach JOIN pn ON pn.id = reach.id GROUP BY electrode, reach.id), """ + CNT + """,
kp AS (SELECT comp.*, first_value(comp.id) OVER (PARTITION BY component ORDER BY coalesce(n, 0) DESC, comp.id) AS keeper FROM comp LEFT JOIN cnt ON comp.id = cnt.id)""",
    "SELECT CAST(electrode AS INTEGER) AS electrode, 'AUTO_MERGE' AS action, keeper AS master_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM kp WHERE id <> keeper GROUP BY electrode, keeper", True)
# every pair of electrodes: a neuron's trace over both neighbourhoods, zero where it has no image
put("discard_by_images", PN + """,
el AS (SELECT DISTINCT electrode AS e FROM pn), pr AS (SELECT a.e AS e1, b.e AS e2, list_sort(list_distinct([a.e - 1, a.e, a.e + 1, b.e - 1, b.e, b.e + 1])) AS u FROM el a JOIN el b ON b.e > a.e),
tq AS (SELECT e1 || '-' || e2 AS pair, id, flatten(list_transform(u, lambda e: CASE WHEN e - electrode BETWEEN -4 AND 3 THEN v[CAST(8 * (e - electrode + 4) + 1 AS INTEGER):CAST(8 * (e - electrode + 5) AS INTEGER)] ELSE [0.0 FOR i IN range(8)] END)) AS t FROM pr JOIN pn ON electrode IN (e1, e2)),
tr AS (SELECT pair, id, list_transform(t, lambda y: y / sqrt(list_sum(list_transform(t, lambda x: x * x)))) AS t FROM tq),
e AS (SELECT a.pair, a.id AS u, b.id AS w FROM tr a JOIN tr b ON a.pair = b.pair AND a.id <> b.id WHERE list_distance(a.t, b.t) * list_distance(a.t, b.t) < 1.0),
reach AS (SELECT pair, u AS id, u AS r FROM e UNION SELECT e.pair, reach.id, e.w FROM reach JOIN e ON e.pair = reach.pair AND e.u = reach.r),
comp AS (SELECT pair, id, min(r) AS component FROM reach GROUP BY pair, id), """ + CNT + """,
kp AS (SELECT comp.*, first_value(comp.id) OVER (PARTITION BY pair, component ORDER BY coalesce(n, 0) DESC, comp.id) AS keeper FROM comp LEFT JOIN cnt ON comp.id = cnt.id)""",
    "SELECT pair, keeper AS master_id, id AS loser_id FROM kp WHERE id <> keeper", True)
put("merged_images", """im AS (SELECT vec_id AS neuron_id, vec_id // 15 + 2 + (k - 1) // 8 - 4 AS electrode, (k - 1) % 8 AS i, CAST(embedding[k] AS DOUBLE) AS x FROM embeddings, range(1, 65) r(k)),
b AS (SELECT neuron_id, electrode, i, x, neuron_id % 7 + 1 AS n FROM im WHERE neuron_id % 5 <> 0 UNION ALL SELECT neuron_id, electrode, i, 2 * x, neuron_id % 4 + 1 FROM im WHERE neuron_id % 3 <> 0)""",
    "SELECT neuron_id, CAST(electrode AS INTEGER) AS electrode, CAST(sum(n) AS BIGINT) AS n, CAST(i AS INTEGER) AS i, " + signed("sum(n * x) / sum(n)") + " AS x FROM b GROUP BY neuron_id, electrode, i")
put("clean_datasets", """o AS (SELECT o_custkey - 1 AS id, o_orderkey AS t FROM orders WHERE o_custkey - 1 IN (SELECT vec_id FROM embeddings)),
lim AS (SELECT max(o_orderkey) AS top FROM orders),
g AS (SELECT id, t - lag(t) OVER (PARTITION BY id ORDER BY t) AS gap FROM o),
st AS (SELECT id, count(*) AS n, count(*) FILTER (gap > 0 AND gap <= 100) AS bad FROM g GROUP BY id),
good AS (SELECT id, n FROM st, lim WHERE n >= 4 AND CASE WHEN n < 2 THEN 0 ELSE CAST(bad AS DOUBLE) / (100.0 * n * n) * (top + 1) END <= 4.0),
pg AS (SELECT vec_id // 15 + 2 AS electrode, vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IN (SELECT id FROM good)),
wt AS (SELECT electrode, id, v[25:48] AS t FROM pg), wn AS (SELECT electrode, id, list_transform(t, lambda y: y / sqrt(list_sum(list_transform(t, lambda x: x * x)))) AS t FROM wt),
we AS (SELECT a.id AS u, b.id AS w FROM wn a JOIN wn b ON a.electrode = b.electrode AND a.id <> b.id WHERE list_sum(list_transform(list_zip(a.t, b.t), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) < 1.1),
r1 AS (SELECT id, id AS r FROM pg UNION SELECT r1.id, we.w FROM r1 JOIN we ON we.u = r1.r),
c1 AS (SELECT id, min(r) AS component FROM r1 GROUP BY id),
k1 AS (SELECT c1.id, n, first_value(c1.id) OVER (PARTITION BY component ORDER BY n DESC, c1.id) AS master FROM c1 JOIN good ON good.id = c1.id),
mc AS (SELECT master AS id, sum(n) AS n FROM k1 GROUP BY master),
h AS (SELECT pg.* FROM pg JOIN mc ON mc.id = pg.id),
el AS (SELECT DISTINCT vec_id // 15 + 2 AS e FROM embeddings), pr AS (SELECT a.e AS e1, b.e AS e2 FROM el a JOIN el b ON b.e = a.e + 1),
tq AS (SELECT e1 || '-' || e2 AS pair, id, v[CAST(8 * (e1 - electrode + 4) + 1 AS INTEGER):CAST(8 * (e2 - electrode + 5) AS INTEGER)] AS t FROM pr JOIN h ON electrode IN (e1, e2)),
tr AS (SELECT pair, id, list_transform(t, lambda y: y / sqrt(list_sum(list_transform(t, lambda x: x * x)))) AS t FROM tq),
e2 AS (SELECT a.pair, a.id AS u, b.id AS w FROM tr a JOIN tr b ON a.pair = b.pair AND a.id <> b.id WHERE list_sum(list_transform(list_zip(a.t, b.t), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) < 1.0),
r2 AS (SELECT pair, u AS id, u AS r FROM e2 UNION SELECT e2.pair, r2.id, e2.w FROM r2 JOIN e2 ON e2.pair = r2.pair AND e2.u = r2.r),
c2 AS (SELECT pair, id, min(r) AS component FROM r2 GROUP BY pair, id),
k2 AS (SELECT c2.*, first_value(c2.id) OVER (PARTITION BY pair, component ORDER BY n DESC, c2.id) AS keeper FROM c2 JOIN mc ON mc.id = c2.id),
gone AS (SELECT DISTINCT id FROM k2 WHERE id <> keeper),
fin AS (SELECT k1.master AS id, t FROM o JOIN k1 ON k1.id = o.id WHERE k1.master NOT IN (SELECT id FROM gone))""",
    "SELECT CASE WHEN t < top // 2 THEN 'a' ELSE 'b' END AS dataset, id AS neuron_id, count(*) AS n, CAST(sum(CASE WHEN t < top // 2 THEN t ELSE t - top // 2 END) AS BIGINT) AS total FROM fin, lim GROUP BY 1, 2", True)
put("recording_range", CH, "SELECT electrode, sample, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 4) AS value FROM ch WHERE sample >= 10 AND sample < 20 AND electrode NOT IN (1, 4)")
put("synthetic_recording", """g AS (SELECT CAST(e AS INTEGER) AS electrode, s AS sample FROM (SELECT unnest(range(1, (SELECT count(*) + 1 FROM nation))) AS e), (SELECT unnest(range(0, (SELECT count(*) FROM customer))) AS s)),
u AS (SELECT *, (""" + HASH.format(key="'1|' || electrode || '|' || sample") + " + 1) / CAST(4294967297 AS DOUBLE) AS u0, (" + HASH.format(key="'2|' || electrode || '|' || sample") + """ + 1) / CAST(4294967297 AS DOUBLE) AS u1 FROM g),
n AS (SELECT r_regionkey AS i, 2 + 4 * r_regionkey AS e, 50 + 10 * r_regionkey AS first, 211 + 30 * r_regionkey AS period FROM region),
q AS (SELECT u.electrode, u.sample, sum(-(200 + 40 * i) * exp(-(((sample - first) % period - 4) * ((sample - first) % period - 4)) / CAST(2 + i AS DOUBLE)) / (1 + 2 * abs(electrode - e))) AS x
  FROM u JOIN n ON abs(electrode - e) <= 1 AND sample >= first AND (sample - first) % period < 10 GROUP BY ALL)""",
    """SELECT u.electrode, u.sample, round(CAST(CAST(CASE WHEN u.electrode = 1 THEN CASE WHEN u.sample % 2000 < 5 THEN -1500.0 ELSE 0.0 END
  ELSE sqrt(-2 * ln(u0)) * cos(2 * 3.141592653589793 * u1) * 10 + 20 * sin(u.sample / CAST(3000 AS DOUBLE)) + coalesce(x, 0) END AS FLOAT) AS DOUBLE), 2) AS value FROM u LEFT JOIN q ON q.electrode = u.electrode AND q.sample = u.sample""")  # fmt: skip
put("stream_windows", CAND, "SELECT sp.electrode, spike_time, CAST(up.sample - spike_time AS INTEGER) AS pos, round(v, 9) AS value FROM sp JOIN up ON up.electrode = sp.electrode AND up.sample BETWEEN spike_time - 2 AND spike_time + 3 JOIN (SELECT electrode, max(sample) AS top FROM ch GROUP BY electrode) e ON e.electrode = sp.electrode WHERE spike_time >= 2 AND spike_time + 3 <= top")
put("recording_header", CH, "SELECT 'run' AS dataset, CAST(count(DISTINCT electrode) AS INTEGER) AS electrodes, CAST(3 AS BIGINT) AS start, max(sample) + 1 AS stop, 2 AS disconnected FROM ch")
GRID = "gr AS (SELECT s_suppkey AS e, s_suppkey % 10 AS x, s_suppkey // 10 AS y FROM supplier), ad AS (SELECT a.e AS electrode, b.e AS neighbor, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM gr a JOIN gr b ON abs(a.x - b.x) <= 2 AND abs(a.y - b.y) <= 2)"
put("adjacency_usage", GRID, "SELECT CAST(u AS INTEGER) AS usage, electrode, neighbor, CAST(row_number() OVER (PARTITION BY u, electrode ORDER BY d2, neighbor) - 1 AS INTEGER) AS ord FROM ad, range(0, 3) r(u) WHERE d2 <= u * u")
put("adjacency_degrees", GRID, "SELECT electrode, count(*) AS degree, max(count(*)) OVER () AS most FROM ad WHERE d2 <= 4 GROUP BY electrode")
put("stage_load", CAND, "SELECT electrode, spike_time, width, round(amplitude, 9) AS amplitude FROM sp")
put("stage_columns", CAND, "SELECT electrode, spike_time FROM sp")
put("stage_electrode", CAND, "SELECT electrode, spike_time, width, round(amplitude, 9) AS amplitude FROM sp WHERE electrode = 5")
put("stage_cells", CAND, "SELECT electrode, spike_time FROM sp WHERE electrode IN (2, 3, 7)")
put("stage_discovery", "", "SELECT * FROM (VALUES ('*-spikes', 'run-spikes'), ('*-neurons', NULL), ('run-*', 'several')) t(pattern, found)")
put("noise_file", CH, "SELECT CAST(row_number() OVER (ORDER BY electrode) AS INTEGER) AS electrode, CASE WHEN row_number() OVER (ORDER BY electrode) = 1 THEN 0.0 ELSE round(stddev_samp(value), 6) END AS sigma FROM ch GROUP BY electrode")
SQL["dataset_list"] = SQL["dataset_strings"]
put("spikes_stage", CAND + ", te AS (SELECT *, coalesce(lag(event_type = 'error') OVER (PARTITION BY electrode ORDER BY sample), FALSE) AS before FROM ch)",
    "SELECT 'spike' AS kind, CAST(spike_time AS INTEGER) AS spike_time, CAST(electrode AS INTEGER) AS electrode FROM sp UNION ALL SELECT 'trigger', CAST(sample AS INTEGER), CAST(electrode AS INTEGER) FROM te WHERE event_type = 'error' AND NOT before UNION ALL SELECT 'n_samples', CAST(max(sample) + 1 AS INTEGER), NULL FROM ch")
put("covariance_stage", XS, "SELECT electrode, CAST(i AS INTEGER) AS i, " + signed("avg(x)") + " AS mean, count(*) AS n, round(var_samp(x), 6) AS cov FROM x GROUP BY electrode, i")
put("model_stage", XS, "SELECT electrode, CAST(id % 3 AS INTEGER) AS clust, CAST(i AS INTEGER) AS i, " + signed("avg(x)") + " AS centroid, count(*) AS n FROM x GROUP BY electrode, id % 3, i")
put("action_stack", KEEP, """SELECT CAST(electrode AS INTEGER) AS electrode, 'AUTO_RM' AS action, NULL AS master_id, string_agg(CAST(pn.id AS VARCHAR), ',' ORDER BY pn.id) AS ids FROM pn LEFT JOIN cnt ON cnt.id = pn.id WHERE coalesce(n, 0) < 5 GROUP BY electrode
UNION ALL SELECT CAST(electrode AS INTEGER), 'AUTO_MERGE', keeper, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FROM kp WHERE members > 1 AND id <> keeper GROUP BY electrode, keeper""", True)  # fmt: skip
put("label_rewrite", "", "SELECT CAST(n_nationkey AS INTEGER) AS neuron_id, 'Edited/' || n_name AS label FROM nation WHERE n_nationkey % 3 = 0")
put("neuron_reader", CAND, "SELECT CAST(electrode * 15 + width % 3 AS INTEGER) AS neuron_id, CAST(electrode + 2 AS INTEGER) AS electrode, count(*) AS n, string_agg(CAST(spike_time - 5 AS VARCHAR), ',' ORDER BY spike_time) AS times FROM sp WHERE width % 3 > 0 GROUP BY 1, 2")
put("image_reader", "", "SELECT vec_id AS neuron_id, vec_id % 5 + 1 AS n, CAST(vec_id // 15 + 2 + (k - 1) // 8 - 4 AS INTEGER) AS electrode, CAST((k - 1) % 8 AS INTEGER) AS i, " + signed("CAST(embedding[k] AS DOUBLE)") + " AS x FROM embeddings, range(1, 65) r(k)")
put("export_projections", "", "SELECT n_nationkey AS electrode, n_nationkey || ',' || n_regionkey AS pc FROM nation WHERE n_regionkey > 0")
put("selected_copy", "", "SELECT CAST(o_custkey % 50 AS INTEGER) AS neuron_id, o_orderkey AS spike_time FROM orders WHERE o_custkey % 50 IN (1, 5)")
put("nearest_model", XS + """,
md AS (SELECT electrode, id % 3 AS clust, i, avg(x) AS c, var_pop(x) AS v, count(*) AS n FROM x GROUP BY ALL), tot AS (SELECT electrode, i, sum(n) AS t FROM md GROUP BY ALL),
ft AS (SELECT x.electrode, x.id, md.clust, max(ln(CAST(md.n AS DOUBLE) / t)) - sum((x - c) * (x - c) / v + ln(v)) / 2 AS fit FROM x JOIN md ON md.electrode = x.electrode AND md.i = x.i JOIN tot ON tot.electrode = md.electrode AND tot.i = md.i GROUP BY ALL)""",
    "SELECT electrode, id AS spike_time, CAST(clust AS INTEGER) AS clust FROM (SELECT *, row_number() OVER (PARTITION BY electrode, id ORDER BY fit DESC, clust) AS nth FROM ft) WHERE nth = 1")
put("settings_tags", "", """SELECT s_suppkey, tag, buffer_size, landmarks, retries, min_spikes, whitening, quality_tolerance FROM supplier JOIN (SELECT *, row_number() OVER () - 1 AS place FROM (VALUES ('', 16384, 2500, 10, 100, TRUE, CAST(0.015 AS DOUBLE)), ('DEFAULT', 16384, 2500, 10, 100, TRUE, 0.015), ('VINCENT1', 32768, 2500, 3, 500, TRUE, 0.015), ('LIGHT_CLUST', 16384, 1000, 10, 100, TRUE, 0.015),
  ('VINCENT2', 32768, 2500, 3, 500, TRUE, 0.015), ('QT0.001', 16384, 2500, 3, 500, TRUE, 0.001), ('QT0.005', 16384, 2500, 3, 500, TRUE, 0.005), ('QT0.010', 16384, 2500, 3, 500, TRUE, 0.010), ('QT0.020', 16384, 2500, 3, 500, TRUE, 0.020),
  ('QT0.025', 16384, 2500, 3, 500, TRUE, 0.025), ('QT0.030', 16384, 2500, 3, 500, TRUE, 0.030), ('NO_WHITE', 16384, 2500, 3, 500, FALSE, 0.015)) t(tag, buffer_size, landmarks, retries, min_spikes, whitening, quality_tolerance)) k ON k.place = s_suppkey % 12""")  # fmt: skip
# an edge merges two parts if the edges before it do not connect its ends; the parts are what those edges reach
put("merge_dendrogram", N2 + """,
e AS (SELECT electrode, id_a AS u, id_b AS w, d2, row_number() OVER (PARTITION BY electrode ORDER BY d2, id_a, id_b) AS k FROM d2 WHERE id_a < id_b AND d2 > 0 AND d2 < 1.6),
b AS (SELECT electrode, k, u AS a, w AS z FROM e UNION ALL SELECT electrode, k, w, u FROM e),
r AS (SELECT * FROM (SELECT electrode, k, 0 AS side, u AS n FROM e UNION ALL SELECT electrode, k, 1, w FROM e) UNION SELECT r.electrode, r.k, r.side, b.z FROM r JOIN b ON b.electrode = r.electrode AND b.k < r.k AND b.a = r.n),
s AS (SELECT electrode, k, side, min(n) AS low, string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) AS ids FROM r GROUP BY ALL)""",
    """SELECT CAST(e.electrode AS INTEGER) AS electrode, CAST(row_number() OVER (PARTITION BY e.electrode ORDER BY e.k) AS INTEGER) AS step, round(e.d2, 6) AS threshold,
  CASE WHEN x.low < y.low THEN x.ids ELSE y.ids END AS left_ids, CASE WHEN x.low < y.low THEN y.ids ELSE x.ids END AS right_ids
  FROM e JOIN s x ON x.electrode = e.electrode AND x.k = e.k AND x.side = 0 JOIN s y ON y.electrode = e.electrode AND y.k = e.k AND y.side = 1 WHERE x.low <> y.low""", True)  # fmt: skip
# the contamination of every prefix of the ranking, then the halving
put("shrink_to_target", SCALE + """,
rk AS (SELECT electrode, id * 13 % 997 AS t, row_number() OVER (PARTITION BY electrode ORDER BY scale * scale, id * 13 % 997) AS rk, CAST(floor(0.8 * count(*) OVER (PARTITION BY electrode)) AS BIGINT) AS m FROM sc),
gp AS (SELECT electrode, l, t - lag(t) OVER (PARTITION BY electrode, l ORDER BY t) AS gap FROM rk JOIN range(1, 100000) r(l) ON l <= m AND rk <= l),
ct AS (SELECT electrode, l, count(*) FILTER (gap > 0 AND gap <= 30) * 1000.0 / (30.0 * l * l) AS c FROM gp GROUP BY electrode, l),
bs AS (SELECT x.electrode, CASE WHEN c < 0.5 THEN x.m ELSE 0 END AS low, x.m AS high FROM (SELECT DISTINCT electrode, m FROM rk) x JOIN ct ON ct.electrode = x.electrode AND ct.l = x.m
  UNION ALL SELECT bs.electrode, CASE WHEN c < 0.5 THEN (low + high) // 2 ELSE low END, CASE WHEN c < 0.5 THEN high ELSE (low + high) // 2 END FROM bs JOIN ct ON ct.electrode = bs.electrode AND ct.l = (low + high) // 2 WHERE high - low > 1),
kn AS (SELECT electrode, max(low) AS n FROM bs GROUP BY electrode)""",
    "SELECT rk.electrode, t, rk <= n AS keep FROM rk JOIN kn ON kn.electrode = rk.electrode", True)
# each round takes the one exchange that brings most, while any does
_COST = "list_sum(list_transform(range(1, n + 1), lambda p: list_sum(list_transform(range(1, n + 1), lambda q: mm[{o}[p]][{o}[q]] * abs(p - q)))))"
put("block_diag_order", XS + """,
me AS (SELECT electrode, i, avg(x) AS m FROM x GROUP BY electrode, i), lab AS (SELECT electrode, row_number() OVER (ORDER BY electrode) AS k FROM (SELECT DISTINCT electrode FROM me)),
nr AS (SELECT la.k AS ka, lb.k AS kb, exp(-sum((a.m - b.m) * (a.m - b.m))) AS w FROM me a JOIN me b ON a.i = b.i JOIN lab la ON la.electrode = a.electrode JOIN lab lb ON lb.electrode = b.electrode GROUP BY la.k, lb.k),
mt AS (SELECT list(r ORDER BY ka) AS mm, count(*) AS n FROM (SELECT ka, list(w ORDER BY kb) AS r FROM nr GROUP BY ka)),
st AS (
  SELECT 0 AS round, range(1, n + 1) AS o, """ + _COST.format(o="range(1, n + 1)") + """ AS cost FROM mt
  UNION ALL
  SELECT round, o, cost FROM (
    SELECT round + 1 AS round, arg_min(o2, {'c': c2, 'i': i, 'j': j}) AS o, min(c2) AS cost, min(cost) AS was, min(n) AS n FROM (
      SELECT *, """ + _COST.format(o="o2") + """ AS c2 FROM (
        SELECT st.round, st.cost, mt.mm, mt.n, i, j, list_transform(range(1, mt.n + 1), lambda p: CASE WHEN p = i THEN st.o[j] WHEN p = j THEN st.o[i] ELSE st.o[p] END) AS o2 FROM st, mt, (SELECT a.k AS i, b.k AS j FROM lab a JOIN lab b ON a.k < b.k) x
      )
    ) GROUP BY round
  ) WHERE cost < was - 1e-12 AND round <= 2 * n
),
fin AS (SELECT o FROM st ORDER BY round DESC LIMIT 1)""",
    "SELECT CAST(p - 1 AS INTEGER) AS place, lab.electrode FROM (SELECT unnest(range(1, len(o) + 1)) AS p, unnest(o) AS k FROM fin) f JOIN lab ON lab.k = f.k", True)
