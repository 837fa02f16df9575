"""SQL for the queries that fold over chunks, sample, and project on principal components."""

from __future__ import annotations

from lacuna.plans.catalogue import BASE, EV, NOVEL, NUMBERED, ORACLE_SQL, covered_sql, greedy_sql, hist_sql, stats_sql

#: What follows the bins of `ref` to the memberships of `cand` in what it lacks.
CLASSES = NOVEL[len(BASE) :]


def guided(reference: str, candidate: str) -> str:
    """The structures of `candidate` that a greedy cover picks against `reference`."""
    return f"""(WITH RECURSIVE ref AS (SELECT * FROM {reference}), cand AS (SELECT * FROM {candidate}), {stats_sql('ref')}, {hist_sql('ref')}{CLASSES}, {NUMBERED}, {greedy_sql('num')}
SELECT structure_id FROM g JOIN rk USING (rank))"""


CHUNK = "(SELECT v.* FROM v JOIN ck USING (structure_id) WHERE chunk = {k})"
ORACLE_SQL["reduce_reference_guided"] = f"""WITH {EV}, base AS (SELECT * FROM e WHERE is_ref), v AS (SELECT * FROM e WHERE NOT is_ref), ids AS (SELECT DISTINCT structure_id FROM v),
ck AS (SELECT structure_id, ntile(2) OVER (ORDER BY structure_id) - 1 AS chunk FROM ids),
s0 AS MATERIALIZED {guided("base", CHUNK.format(k=0))},
s1 AS MATERIALIZED {guided("(SELECT * FROM base UNION ALL SELECT v.* FROM v WHERE structure_id IN (SELECT structure_id FROM s0))", CHUNK.format(k=1))}
SELECT structure_id, structure_id IN (SELECT structure_id FROM s0 UNION SELECT structure_id FROM s1) AS selected FROM ids"""

#: Places of a cover p(structure_id, freq, place, len) that the stride of the budget b(num) keeps.
STRIDE = """SELECT structure_id, freq, place::INTEGER AS place FROM p, b WHERE num > 0 AND CASE WHEN len <= num THEN place < num
  ELSE place < num // 5 OR (place - num // 5) % greatest(1, (len - num // 5) // greatest(1, num - num // 5)) = 0 END"""
PLACED = "cov AS (SELECT structure_id, freq FROM g JOIN rk USING (rank)), p AS (SELECT *, row_number() OVER (ORDER BY freq DESC, structure_id) - 1 AS place, count(*) OVER () AS len FROM cov)"

ORACLE_SQL["generation_sample"] = f"""{NOVEL.replace("WITH", "WITH RECURSIVE", 1)}, {covered_sql('cand', ('elem',))}, rates AS (SELECT elem, 100.0::DOUBLE * avg(covered::INT::DOUBLE) AS rate FROM l GROUP BY elem),
b AS (SELECT coalesce((SELECT budget FROM rates, (VALUES (0, 90.0::DOUBLE, 40), (1, 99.0, 20), (2, 100.0, 10)) t(stage, threshold, budget) WHERE rate < threshold ORDER BY threshold, stage LIMIT 1), 0) AS num),
gated AS (SELECT mem.* FROM mem JOIN rates USING (elem) WHERE rate < 100), num AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY elem, interval_id) - 1 AS class_seq, structure_id, atom_idx FROM gated), {greedy_sql('num')}, {PLACED} {STRIDE}"""

#: Each dimension of the one pseudo-element stands for an element: classes are in order of dimensions, then intervals.
MEANS = "e AS (SELECT vec_id AS structure_id, 0 AS atom_idx, vec_id % 2 = 0 AS is_ref, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) - 1 AS elem FROM embeddings)"
ORACLE_SQL["mean_descriptor_sample"] = f"""{NOVEL.replace(EV, MEANS).replace("WITH", "WITH RECURSIVE", 1)}, {covered_sql('cand', ('elem',))}, rates AS (SELECT avg(rate) AS rate FROM (SELECT elem, 100.0::DOUBLE * avg(covered::INT::DOUBLE) AS rate FROM l GROUP BY elem)),
b AS (SELECT coalesce((SELECT budget FROM rates, (VALUES (0, 90.0::DOUBLE, 20), (1, 100.0, 10)) t(stage, threshold, budget) WHERE rate < threshold ORDER BY threshold, stage LIMIT 1), 0) AS num), {NUMBERED}, {greedy_sql('num')}, {PLACED} {STRIDE}"""


# ---- principal components

ROUNDS = 14


def component(c: str, name: str) -> str:
    """CTEs to {name}(elem, i, x), the first eigenvector of c(elem, i, j, v), with its largest entry positive, and {name}_l(elem,
    value). The matrix is squared again and again, which leaves the largest eigenvalue's projector."""
    out, before = [f"{name}0 AS MATERIALIZED (SELECT elem, i, j, v / t AS v FROM {c} JOIN (SELECT elem, sum(v) AS t FROM {c} WHERE i = j GROUP BY elem) USING (elem))"], f"{name}0"
    for k in range(1, ROUNDS + 1):
        out.append(f"{name}q{k} AS MATERIALIZED (SELECT a.elem, a.i, b.j, sum(a.v * b.v) AS v FROM {before} a JOIN {before} b ON a.elem = b.elem AND a.j = b.i GROUP BY a.elem, a.i, b.j)")
        out.append(f"{name}{k} AS MATERIALIZED (SELECT elem, i, j, v / t AS v FROM {name}q{k} JOIN (SELECT elem, sum(v) AS t FROM {name}q{k} WHERE i = j GROUP BY elem) USING (elem))")
        before = f"{name}{k}"
    out.append(f"{name}m AS (SELECT elem, arg_max(i, v) AS m, max(v) AS top FROM {before} WHERE i = j GROUP BY elem)")
    out.append(f"{name} AS MATERIALIZED (SELECT p.elem, p.i, p.v / sqrt(top) AS x FROM {before} p JOIN {name}m ON p.elem = {name}m.elem AND p.j = m)")
    out.append(f"{name}_l AS MATERIALIZED (SELECT c.elem, sum(a.x * c.v * b.x) AS value FROM {c} c JOIN {name} a ON a.elem = c.elem AND a.i = c.i JOIN {name} b ON b.elem = c.elem AND b.i = c.j GROUP BY c.elem)")
    return ",\n".join(out)


def model(source: str) -> str:
    """CTEs to the two components of source(elem, id, dim, v): mo (mean and scale of each dimension), u and w (elem, i, x), and
    ex(elem, explained)."""
    return f"""mo AS MATERIALIZED (SELECT elem, dim, count(*) AS n, avg(v) AS mu, CASE WHEN var_pop(v) > 1e-12 * greatest(1, avg(v) * avg(v)) THEN stddev_pop(v) ELSE 1 END AS sd FROM {source} GROUP BY elem, dim),
zs AS MATERIALIZED (SELECT s.elem, s.id, s.dim, (s.v - mu) / sd AS z, n FROM {source} s JOIN mo ON s.elem = mo.elem AND s.dim = mo.dim),
c AS MATERIALIZED (SELECT a.elem, a.dim AS i, b.dim AS j, sum(a.z * b.z) / any_value(a.n) AS v FROM zs a JOIN zs b ON a.elem = b.elem AND a.id = b.id GROUP BY a.elem, a.dim, b.dim),
{component("c", "u")},
d AS MATERIALIZED (SELECT c.elem, c.i, c.j, c.v - u_l.value * a.x * b.x AS v FROM c JOIN u_l ON u_l.elem = c.elem JOIN u a ON a.elem = c.elem AND a.i = c.i JOIN u b ON b.elem = c.elem AND b.i = c.j),
{component("d", "w")},
ex AS (SELECT elem, (u_l.value + w_l.value) / t AS explained FROM u_l JOIN w_l USING (elem) JOIN (SELECT elem, sum(v) AS t FROM c WHERE i = j GROUP BY elem) USING (elem)),
su AS (SELECT elem, sign(arg_max(x, abs(x))) AS s FROM u GROUP BY elem), sw AS (SELECT elem, sign(arg_max(x, abs(x))) AS s FROM w GROUP BY elem)"""


def projected(source: str, keep: str = "") -> str:
    """elem, id, (keep,) pc1 and pc2 of source(elem, id, dim, v)."""
    more = f", any_value(p.{keep}) AS {keep}" if keep else ""
    return f"""SELECT p.elem, p.id{more}, any_value(su.s) * sum((p.v - mu) / sd * u.x) AS pc1, any_value(sw.s) * sum((p.v - mu) / sd * w.x) AS pc2 FROM {source} p JOIN mo ON mo.elem = p.elem AND mo.dim = p.dim
JOIN u ON u.elem = p.elem AND u.i = p.dim JOIN w ON w.elem = p.elem AND w.i = p.dim JOIN su ON su.elem = p.elem JOIN sw ON sw.elem = p.elem GROUP BY p.elem, p.id"""


def grid(source: str, keys: str, value: str, name: str) -> str:
    """CTE {name}(keys, a, z, nb): the coverage grid of a value."""
    return f"""{name}0 AS (SELECT {keys}, count(*) AS n, min({value}) AS a, max({value}) AS z, quantile_cont({value}, 0.75) - quantile_cont({value}, 0.25) AS iqr FROM {source} GROUP BY {keys}),
{name} AS (SELECT {keys}, a, z, CASE WHEN z > a THEN greatest(1, floor((z - a) / CASE WHEN 2.0::DOUBLE * iqr / pow(n, 1.0::DOUBLE / 3) > 0 THEN 2.0::DOUBLE * iqr / pow(n, 1.0::DOUBLE / 3) ELSE z - a END)) ELSE 1 END AS nb FROM {name}0)"""


def cell(value: str, g: str) -> str:
    return f"CASE WHEN {value} >= {g}.a AND {value} < {g}.z THEN least(floor(({value} - {g}.a) / (({g}.z - {g}.a) / {g}.nb)), {g}.nb - 1) END"


VECTORS = "e AS MATERIALIZED (SELECT vec_id AS id, label AS elem, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings), r AS MATERIALIZED (SELECT *, (id % 8) // 2 - 1 AS main FROM e WHERE id % 2 = 0), q AS MATERIALIZED (SELECT * FROM e WHERE id % 2 = 1)"
CELLS = f"""{grid("pq", "elem", "pc1", "g1")}, {grid("pq", "elem", "pc2", "g2")},
qc AS (SELECT pq.elem, id, {cell("pc1", "g1")} AS c1, {cell("pc2", "g2")} AS c2 FROM pq JOIN g1 ON g1.elem = pq.elem JOIN g2 ON g2.elem = pq.elem)"""

ORACLE_SQL["pca_explained"] = f"WITH {VECTORS}, {model('e')} SELECT elem, round(explained, 6) AS explained FROM ex"
ORACLE_SQL["pca_grid_coverage"] = f"""WITH {VECTORS}, {model('r')}, pq AS MATERIALIZED ({projected('q')}), pr AS MATERIALIZED ({projected('r')}), {CELLS},
rc AS (SELECT DISTINCT pr.elem, {cell("pc1", "g1")} AS c1, {cell("pc2", "g2")} AS c2 FROM pr JOIN g1 ON g1.elem = pr.elem JOIN g2 ON g2.elem = pr.elem)
SELECT qc.elem, count(*) AS n_query, count(rc.c1) AS n_covered, round(count(rc.c1) / count(*)::DOUBLE, 10) AS coverage FROM qc LEFT JOIN rc ON rc.elem = qc.elem AND rc.c1 = qc.c1 AND rc.c2 = qc.c2 GROUP BY qc.elem"""
ORACLE_SQL["coverage_report"] = f"""WITH {VECTORS}, {model('e')}, lb AS (SELECT main, row_number() OVER (ORDER BY main) - 1 AS pos FROM (SELECT DISTINCT main FROM r)),
pq AS MATERIALIZED ({projected('q')}), pr AS MATERIALIZED ({projected('r', 'main')}), {CELLS},
rc AS (SELECT pr.elem, {cell("pc1", "g1")} AS c1, {cell("pc2", "g2")} AS c2, min(pos) AS first FROM pr JOIN lb USING (main) JOIN g1 ON g1.elem = pr.elem JOIN g2 ON g2.elem = pr.elem GROUP BY ALL),
two AS (SELECT pos, qc.elem, count(*) AS n_query, count(*) FILTER (WHERE first <= pos) AS n2 FROM qc CROSS JOIN lb LEFT JOIN rc ON rc.elem = qc.elem AND rc.c1 = qc.c1 AND rc.c2 = qc.c2 GROUP BY ALL),
{grid("q", "elem, dim", "v", "g")},
sc AS (SELECT q.elem, q.dim, {cell("v", "g")} AS cell FROM q JOIN g ON g.elem = q.elem AND g.dim = q.dim),
xc AS (SELECT r.elem, r.dim, {cell("v", "g")} AS cell, min(pos) AS first FROM r JOIN g ON g.elem = r.elem AND g.dim = r.dim JOIN lb USING (main) GROUP BY ALL),
one AS (SELECT pos, sc.elem, sc.dim, count(*) AS n, count(*) FILTER (WHERE first <= pos) AS n1 FROM sc CROSS JOIN lb LEFT JOIN xc ON xc.elem = sc.elem AND xc.dim = sc.dim AND xc.cell = sc.cell GROUP BY ALL),
mean AS (SELECT pos, elem, avg(n1 / n::DOUBLE) AS coverage_1d, avg(n1) AS mean_covered FROM one GROUP BY ALL),
inp AS (SELECT b.pos, y.elem, count(*) AS n_input FROM (SELECT DISTINCT id, elem, main FROM r) y JOIN lb a ON a.main = y.main JOIN lb b ON a.pos <= b.pos GROUP BY ALL)
SELECT pos::INTEGER AS label_pos, CASE WHEN main = -1 THEN 'init' ELSE 'loop-' || (main + 1) END AS label, elem, n_query, n_input, n2 AS n_covered_2d, round(n2 / n_query::DOUBLE, 10) AS coverage_2d, round(coverage_1d, 10) AS coverage_1d, round(mean_covered, 10) AS mean_covered_1d, round(explained, 6) AS explained
FROM two JOIN lb USING (pos) JOIN mean USING (pos, elem) JOIN inp USING (pos, elem) JOIN ex USING (elem)"""
