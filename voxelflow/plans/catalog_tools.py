"""Queries of the staged tools P6 and P9-P13, and of I7, with sequential oracles.

Every tool writes its stages to a fresh store in the shared folder and reads
them back (``plans.stages``).  The oracles follow the sequential description of each
step: floods and mutex clustering take one edge per block and recursion step,
in the total order that the operators define.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import grid
from ..operators import affinity, segment
from ..sources import fixtures as fx
from ..sources import ledger as led
from ..sources import volume
from ..sources.fixtures import A_SQL, with_sql
from . import catalog, stages, tools
from .catalog import DT_RES, DT_W5, DT_W6, OFFS, RAIN_THR, WB, register
from .stages import new_store


def stored(spark, path, df, name, block=WB):
    """``df`` written and read back, and the extent that its write measured."""
    row = stages.write_output(led.Ledger(spark, path), df, path, name, block)
    return volume.read_volume(spark, path, name), tuple(row["dims"])


# ---------------------------------------------------------------------------
# SQL of the steps
# ---------------------------------------------------------------------------

def _blk(b: int, p: str = "") -> str:
    """A block's number."""
    return f"(({p}z // {b}) * 1000 + {p}y // {b}) * 1000 + {p}x // {b}"


def _ext(src: str) -> str:
    return f"EXT AS (SELECT max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz FROM {src})"


def seeds_sql(rel: str, thr: float, b: int, faces: bool, out: str = "SEEDS") -> str:
    """H1 or H2, then H3."""
    at_least = f"p.v >= CAST('{thr}' AS DOUBLE)"
    if faces:
        maxima = catalog._edge_max_sql().replace("RELIEF", rel).replace("NOT EXISTS", f"{at_least} AND NOT EXISTS")
    else:
        maxima = f"""SELECT p.x, p.y, p.z FROM {rel} p WHERE NOT isnan(p.v) AND {at_least} AND NOT EXISTS (
  SELECT 1 FROM {rel} q WHERE {catalog._nbr_sql('p', 'q', b)} AND NOT isnan(q.v) AND q.v > p.v)"""
    return f"""{out} AS (SELECT x, y, z, row_number() OVER (PARTITION BY x // {b}, y // {b}, z // {b} ORDER BY z, y, x) AS seed
  FROM ({maxima}) t)"""


def grow_sql(nodes: str, edges: str, out: str) -> str:
    """The strongest edge that leaves the marked set passes its marker on, one per block and step."""
    return f"""{out}_B AS (SELECT n1, n2, blk, w, t, least(n1, n2) AS lo, greatest(n1, n2) AS hi FROM {edges}
      UNION ALL SELECT n2, n1, blk, w, t, least(n1, n2), greatest(n1, n2) FROM {edges}),
{out}_G AS (WITH RECURSIVE g(node, blk, marker) USING KEY (node) AS (
    SELECT node, blk, marker FROM {nodes} WHERE marker <> 0
    UNION
    SELECT node, blk, marker FROM (
      SELECT e.n2 AS node, e.blk, r.marker,
             row_number() OVER (PARTITION BY e.blk ORDER BY e.w DESC, e.t DESC, e.lo DESC, e.hi DESC) AS rk
      FROM (SELECT DISTINCT blk FROM g) live JOIN recurring.g r ON r.blk = live.blk
      JOIN {out}_B e ON e.n1 = r.node
      WHERE NOT EXISTS (SELECT 1 FROM recurring.g s WHERE s.node = e.n2)) q
    WHERE rk = 1)
  SELECT node, marker FROM g),
{out} AS (SELECT n.x, n.y, n.z, CAST(coalesce(g.marker, 0) AS BIGINT) AS label FROM {nodes} n LEFT JOIN {out}_G g USING (node))"""


def flood_sql(rel: str, b: int, impassable_zero: bool, out: str, seeds: str = "SEEDS") -> str:
    """I3."""
    return f"""{out}_N AS (SELECT x, y, z, x + nx * (y + ny * z) AS node, {_blk(b)} AS blk, coalesce(seed, 0) AS marker,
                 CASE WHEN seed IS NULL THEN v ELSE CAST('inf' AS DOUBLE) END AS v
          FROM {rel} LEFT JOIN {seeds} USING (x, y, z), EXT WHERE NOT isnan(v){' AND v <> 0' if impassable_zero else ''}),
{out}_E AS (SELECT p.node AS n1, q.node AS n2, p.blk, least(p.v, q.v) AS w, greatest(p.v, q.v) AS t
          FROM {out}_N p JOIN (VALUES (1, 0, 0), (0, 1, 0), (0, 0, 1)) o(dx, dy, dz) ON TRUE
          JOIN {out}_N q ON q.x = p.x + dx AND q.y = p.y + dy AND q.z = p.z + dz AND q.blk = p.blk),
""" + grow_sql(f"{out}_N", f"{out}_E", out)


def components_sql(edges: str, out: str) -> str:
    """J5 by spreading the smallest number."""
    return f"""{out}_U AS (SELECT e1 AS a, e2 AS b FROM {edges} WHERE e1 <> e2 UNION SELECT e2, e1 FROM {edges} WHERE e1 <> e2),
{out} AS (WITH RECURSIVE cc(node, root) USING KEY (node) AS (
    SELECT a, least(a, min(b)) FROM {out}_U GROUP BY a
    UNION
    SELECT u.a, min(c.root) FROM cc c JOIN {out}_U u ON u.b = c.node JOIN recurring.cc r ON r.node = u.a
    GROUP BY u.a, r.root HAVING min(c.root) < r.root)
  SELECT node AS label, root FROM cc)"""


_MEDIAN = "list_sort(list(a))[len(list(a)) // 2 + 1]"


def fragments_sql(ws: str, by: str, b: int, thr: float, out: str) -> str:
    """I5 and its merge inside blocks, then I9."""
    contacts = catalog._block_contacts_sql(ws, b).replace("RELIEF", by)
    number = f"(({{p}}bz * 1000 + {{p}}by_) * 1000 + {{p}}bx) * 1000000 + {{p}}{{e}}"
    return f"""{out}_C AS ({contacts}),
{out}_P AS (SELECT {number.format(p='', e='e1')} AS e1, {number.format(p='', e='e2')} AS e2 FROM (
    SELECT bx, by_, bz, e1, e2, {_MEDIAN} AS med FROM (SELECT bx, by_, bz, e1, e2, unnest([v1, v2]) AS a FROM {out}_C) t
    WHERE a IS NOT NULL AND NOT isnan(a) GROUP BY bx, by_, bz, e1, e2) m WHERE med > CAST('{thr}' AS DOUBLE)),
{components_sql(f'{out}_P', f'{out}_K')},
{out}_M AS (SELECT w.x, w.y, w.z, coalesce(k.root % 1000000, w.label) AS label FROM {ws} w
  LEFT JOIN {out}_K k ON k.label = ({_blk(b, 'w.')}) * 1000000 + w.label),
{single_sql(f'{out}_M', b, 2, out)}"""


def single_sql(src: str, b: int, least: int, out: str) -> str:
    """I9, I10."""
    return f"""{out} AS (SELECT x, y, z, CASE WHEN count(*) OVER (PARTITION BY x // {b}, y // {b}, z // {b}, label) < {least}
    THEN CAST(0 AS BIGINT) ELSE label END AS label FROM {src})"""


def stitched_sql(src: str, b: int, out: str, by: str | None = None, thr: float = 0.0) -> str:
    """J3, J6 (or J7 without values), J5, J9."""
    faces = catalog._face_sql(f"{out}_D", b, by is not None, by or "")
    if by is None:
        edges = f"""{out}_N AS (SELECT bx, by_, bz, axis, l1, l2, count(*) AS n FROM {out}_F GROUP BY ALL),
{out}_J AS (SELECT l1 AS e1, l2 AS e2 FROM (SELECT *,
    row_number() OVER (PARTITION BY bx, by_, bz, axis, l1 ORDER BY n DESC, l2) AS r1,
    row_number() OVER (PARTITION BY bx, by_, bz, axis, l2 ORDER BY n DESC, l1) AS r2 FROM {out}_N) t WHERE r1 = 1 AND r2 = 1)"""
    else:
        edges = f"""{out}_J AS (SELECT e1, e2 FROM (
    SELECT bx, by_, bz, axis, e1, e2, {_MEDIAN} AS med
    FROM (SELECT bx, by_, bz, axis, least(l1, l2) AS e1, greatest(l1, l2) AS e2, unnest([v1, v2]) AS a FROM {out}_F WHERE l1 <> l2) t
    WHERE a IS NOT NULL AND NOT isnan(a) GROUP BY bx, by_, bz, axis, e1, e2) m WHERE med > CAST('{thr}' AS DOUBLE))"""
    return f"""{catalog._dense_sql(src, b, f'{out}_D')},
{out}_F AS ({faces}),
{edges},
{components_sql(f'{out}_J', f'{out}_K')},
{out} AS (SELECT d.x, d.y, d.z, coalesce(k.root, d.label) AS label FROM {out}_D d LEFT JOIN {out}_K k USING (label))"""


def mutex_sql(aff: str, thr: float, b: int, out: str) -> str:
    """Per block and step the strongest attractive edge between two clusters that no stronger repulsive edge keeps apart."""
    return f"""{out}_N AS (SELECT DISTINCT x, y, z, x + nx * (y + ny * z) AS node, {_blk(b)} AS blk FROM {aff}, EXT),
{out}_E AS (SELECT p.blk, p.node AS n1, q.node AS n2, a.a >= {thr} AS att,
             {{'s': CASE WHEN a.a >= {thr} THEN a.a ELSE 1.0 - a.a END, 'lo': least(p.node, q.node), 'hi': greatest(p.node, q.node)}} AS k
      FROM {aff} a JOIN OFFS USING (c) JOIN {out}_N p ON p.x = a.x AND p.y = a.y AND p.z = a.z
      JOIN {out}_N q ON q.x = a.x + dx AND q.y = a.y + dy AND q.z = a.z + dz AND q.blk = p.blk WHERE NOT isnan(a.a)),
{out}_G AS (WITH RECURSIVE m(node, blk, comp) USING KEY (node) AS (
    SELECT node, blk, node FROM {out}_N
    UNION
    SELECT c.node, c.blk, w.c1 FROM (
      SELECT blk, c1, c2, row_number() OVER (PARTITION BY blk ORDER BY ka DESC) AS rk FROM (
        SELECT e.blk, least(a.comp, b.comp) AS c1, greatest(a.comp, b.comp) AS c2,
               max(e.k) FILTER (e.att) AS ka, max(e.k) FILTER (NOT e.att) AS kr
        FROM (SELECT DISTINCT blk FROM m) live JOIN {out}_E e ON e.blk = live.blk
        JOIN recurring.m a ON a.node = e.n1 JOIN recurring.m b ON b.node = e.n2
        WHERE a.comp <> b.comp GROUP BY e.blk, c1, c2) p
      WHERE ka IS NOT NULL AND (kr IS NULL OR ka > kr)) w
    JOIN recurring.m c ON c.blk = w.blk AND c.comp = w.c2 WHERE w.rk = 1)
  SELECT node, comp FROM m),
{out} AS (SELECT n.x, n.y, n.z, CAST(g.comp + 1 AS BIGINT) AS label FROM {out}_N n JOIN {out}_G g USING (node))"""


_AVG = catalog._avg_sql(False, False)
_OUT = "SELECT x, y, z, label FROM "


# ---------------------------------------------------------------------------
# P6
# ---------------------------------------------------------------------------

_REL = "REL AS (SELECT x, y, z, CASE WHEN isnan(v) THEN CAST('-inf' AS DOUBLE) ELSE v END AS v FROM {})"


@register("watershed_stitched", with_sql(
    A_SQL, _AVG, _REL.format("AVG"), _ext("REL"), seeds_sql("REL", 0.5, WB, False), flood_sql("REL", WB, False, "WS"),
    fragments_sql("WS", "REL", WB, 0.5, "MG"), stitched_sql("MG", WB, "FIN", "REL", 0.5)) + _OUT + "FIN")
def q_watershed_stitched(spark, sf):
    """P6 end to end on the averaged affinities: seeds, per-block flood, median fragment merge, singleton
    removal, dense ids, face-median stitching, connected components and mapping, every stage written."""
    path = new_store(spark, "watersheds")
    avg, dims = stored(spark, path, affinity.average_affinities(fx.edge_affinities(spark, sf), OFFS), "averaged")
    plan = tools.stitched_stages(dims, WB, seed_thr=0.5, merge_thr=0.5, face_thr=0.5)
    return stages.run(spark, path, plan, {"relief": avg}, WB, dims)["block-merged"]


# ---------------------------------------------------------------------------
# P10-P12
# ---------------------------------------------------------------------------

DT_THR, DT_MERGE = 0.45, 0.5


def _dt_oracle(kind: str, faces: bool) -> str:
    if kind == "binary":
        start = f"SELECT x, y, z, v, CASE WHEN isnan(v) OR v < {DT_THR} THEN 0.0 ELSE CAST('inf' AS DOUBLE) END AS f FROM AVG"
        dist = catalog._dt_sql(start, DT_W5)
    else:
        dist = catalog._dt_sql("SELECT x, y, z, v, CASE WHEN isnan(v) THEN 0.0 ELSE v * v END AS f FROM AVG", DT_W6)
    # the extent comes first, the distances last: name them
    head, tail = dist.rsplit("\nSELECT", 1)
    return with_sql(A_SQL, _AVG, head.replace("RELIEF", "AVG"), f"DT AS (SELECT{tail})", _REL.format("AVG"),
                    seeds_sql("DT", 0.0, WB, faces), flood_sql("DT", WB, True, "WS"),
                    fragments_sql("WS", "REL", WB, DT_MERGE, "MG"), stitched_sql("MG", WB, "FIN", "REL", DT_MERGE)) + _OUT + "FIN"


def _dt(spark, sf, **how):
    path = new_store(spark, "watersheds")
    avg, dims = stored(spark, path, affinity.average_affinities(fx.edge_affinities(spark, sf), OFFS), "averaged")
    plan = tools.dt_stages(dims, WB, resolution=DT_RES, merge_thr=DT_MERGE, **how)
    return stages.run(spark, path, plan, {"affinities": avg}, WB, dims)["block-merged"]


@register("dt_watershed_binary", _dt_oracle("binary", False))
def q_dt_watershed_binary(spark, sf):
    """P10 end to end: binary distance relief, merged by averaged affinities."""
    return _dt(spark, sf, kind="binary", thr=DT_THR)


@register("dt_watershed_sampled", _dt_oracle("sampled", False))
def q_dt_watershed_sampled(spark, sf):
    """P11 end to end: sampled distance relief."""
    return _dt(spark, sf, kind="sampled")


@register("dt_watershed_faces", _dt_oracle("sampled", True))
def q_dt_watershed_faces(spark, sf):
    """P12 end to end: sampled distance relief, seeds on block faces only."""
    return _dt(spark, sf, kind="sampled", seeds="faces")


# ---------------------------------------------------------------------------
# P9
# ---------------------------------------------------------------------------

def _rain_oracle(least: int) -> str:
    edges = f"""GROW_N AS (SELECT s.x, s.y, s.z, s.x + nx * (s.y + ny * s.z) AS node, {_blk(WB, 's.')} AS blk, s.label AS marker FROM SIZED s, EXT),
GROW_E AS (SELECT p.node AS n1, q.node AS n2, p.blk, a.a AS w, 0.0 AS t
  FROM AFF a JOIN OFFS USING (c) JOIN GROW_N p ON p.x = a.x AND p.y = a.y AND p.z = a.z
  JOIN GROW_N q ON q.x = a.x + dx AND q.y = a.y + dy AND q.z = a.z + dz AND q.blk = p.blk WHERE NOT isnan(a.a))"""
    return with_sql(
        A_SQL, catalog._SYM_SQL, f"""BE AS (SELECT DISTINCT r1.root AS e1, r2.root AS e2 FROM ED
         JOIN RAIN r1 ON r1.node = ED.n1 JOIN RAIN r2 ON r2.node = ED.n2 WHERE ED.a >= {RAIN_THR} AND r1.root <> r2.root)""",
        components_sql("BE", "BM"),
        f"MG AS (SELECT {catalog._XYZ_SQL}, coalesce(BM.root, RAIN.root) + 1 AS label FROM RAIN LEFT JOIN BM ON BM.label = RAIN.root, EXT)",
        single_sql("MG", WB, least, "SIZED"), edges, grow_sql("GROW_N", "GROW_E", "GROW"),
        catalog._dense_sql("GROW", WB, "FIN")) + _OUT + "FIN"


def _rain(spark, sf, **how):
    path = new_store(spark, "rain")
    aff, dims = stored(spark, path, fx.edge_affinities(spark, sf), "affinities")
    return stages.run(spark, path, tools.rain_stages(OFFS, dims, WB, thr=RAIN_THR, **how), {"affinities": aff}, WB, dims,
                      wanted=("seeded",))["seeded"]


@register("rain_pipeline", _rain_oracle(0))
def q_rain_pipeline(spark, sf):
    """P9 end to end: dense labels of the grown basins."""
    return _rain(spark, sf)


@register("rain_pipeline_sized", _rain_oracle(40))
def q_rain_pipeline_sized(spark, sf):
    """P9 with a size filter: basins under 40 voxels are grown over by their neighbours."""
    return _rain(spark, sf, min_size=40)


# ---------------------------------------------------------------------------
# I7, P13
# ---------------------------------------------------------------------------

@register("mutex_watershed", with_sql(A_SQL, _ext("AFF"), mutex_sql("AFF", 0.5, WB, "MX")) + _OUT + "MX")
def q_mutex_watershed(spark, sf):
    """I7 with the threshold rule (a >= 0.5 attractive), 8^3 blocks."""
    aff, dims = stored(spark, new_store(spark, "mutex"), fx.edge_affinities(spark, sf), "affinities")
    return segment.mutex_segmentation(aff, OFFS, dims, WB, thr=0.5)


_WEIGHTED = """MG0 AS (SELECT x, y, z, coalesce(m, 0) AS m, 1.0 - least(1.0, greatest(0.0, coalesce(g, 0.0))) AS gw
         FROM MASK FULL JOIN GLIA USING (x, y, z)),
WA AS (SELECT e.x, e.y, e.z, e.c,
       CASE WHEN coalesce(s.m, 0) = 1 AND coalesce(t.m, 0) = 1 THEN e.a * s.gw * t.gw ELSE CAST('nan' AS DOUBLE) END AS a
  FROM (AFF JOIN OFFS USING (c)) e LEFT JOIN MG0 s ON s.x = e.x AND s.y = e.y AND s.z = e.z
  LEFT JOIN MG0 t ON t.x = e.x + e.dx AND t.y = e.y + e.dy AND t.z = e.z + e.dz)"""


def mutex_pipeline_sql(thr: float, weighted: str = _WEIGHTED) -> str:
    return with_sql(A_SQL, weighted, _ext("AFF"), mutex_sql("WA", thr, WB, "MX"), single_sql("MX", WB, 2, "MS"),
                    stitched_sql("MS", WB, "FIN")) + _OUT + "FIN"


@register("mutex_pipeline", mutex_pipeline_sql(0.3))
def q_mutex_pipeline(spark, sf):
    """P13 end to end with mask and glia: stitched labels."""
    path = new_store(spark, "mutex")
    aff, dims = stored(spark, path, fx.edge_affinities(spark, sf), "affinities")
    given = {"affinities": aff, "mask": fx.mask_volume(spark, sf), "glia": fx.glia_volume(spark, sf)}
    return stages.run(spark, path, tools.mutex_stages(OFFS, dims, WB, True, True, thr=0.3), given, WB, dims)["merged"]


# ---------------------------------------------------------------------------
# Volumes of other resolution and offset
# ---------------------------------------------------------------------------

_SHIFTED = """SM AS (SELECT q.x, q.y, q.z, coalesce(k.m, 0) AS m, coalesce(g.g, 0.0) AS g
  FROM (SELECT DISTINCT x, y, z FROM AFF) q
  LEFT JOIN MASK k ON k.x = q.x - 1 AND k.y = q.y AND k.z = q.z - 2
  LEFT JOIN HALF g ON g.x = q.x // 2 AND g.y = q.y // 2 AND g.z = q.z // 2),
WA AS (SELECT e.x, e.y, e.z, e.c, CASE WHEN coalesce(s.m, 0) = 1 AND coalesce(t.m, 0) = 1
         THEN e.a * (1.0 - least(1.0, greatest(0.0, s.g))) * (1.0 - least(1.0, greatest(0.0, t.g))) ELSE CAST('nan' AS DOUBLE) END AS a
  FROM (AFF JOIN OFFS USING (c)) e LEFT JOIN SM s ON s.x = e.x AND s.y = e.y AND s.z = e.z
  LEFT JOIN SM t ON t.x = e.x + e.dx AND t.y = e.y + e.dy AND t.z = e.z + e.dz)"""
_HALF = "HALF AS (SELECT x // 2 AS x, y // 2 AS y, z // 2 AS z, max(g) AS g FROM GLIA GROUP BY 1, 2, 3)"


@register("mutex_pipeline_shifted", mutex_pipeline_sql(0.3, _HALF + ",\n" + _SHIFTED))
def q_mutex_pipeline_shifted(spark, sf):
    """P13 with a mask stored at an offset of (1, 0, 2) voxels and glia at half the resolution; zero outside."""
    path = new_store(spark, "mutex")
    ledger = led.Ledger(spark, path)
    like = led.write_volume(ledger, fx.edge_affinities(spark, sf), path, "affinities", 0, WB, resolution=(4, 4, 8))
    aff, dims = led.open_volume(spark, path, "affinities"), tuple(like["dims"])
    led.write_volume(ledger, fx.mask_volume(spark, sf), path, "mask", 0, WB, resolution=(4, 4, 8), offset=(4, 0, 16))
    half = fx.glia_volume(spark, sf).groupBy(*[grid.floor_div(a, 2).alias(a) for a in "xyz"]).agg(F.max("g").alias("g"))
    led.write_volume(ledger, half, path, "glia", 0, WB, resolution=(8, 8, 16))
    voxels = aff.select("x", "y", "z").distinct()
    given = {"affinities": aff, "mask": led.open_aligned(spark, path, "mask", voxels, like, "m", 0),
             "glia": led.open_aligned(spark, path, "glia", voxels, like, "g", 0.0)}
    return stages.run(spark, path, tools.mutex_stages(OFFS, dims, WB, True, True, thr=0.3), given, WB, dims)["merged"]
