"""The reference's tools as compositions of operators.

Each tool is a function from frames to a dict of lazy outputs, or a list of
stages (P6, P9-P13) that ``stages.run`` writes one by one and ``stages.compose``
chains lazily.  ``write_outputs`` writes outputs block-addressed (A3) and records
them in the store's ledger (A13).  Nothing here runs its own loop over
blocks: the per-block work is expressed by the block columns in the keys.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import attrs, grid
from ..operators import (affinity, convert, distance, extrema, graph, index, mask, pyramid,
                         segment, stitch, unique)
from ..sources import ledger as led
from ..sources import volume
from . import stages as st
from .stages import Stage


# ---------------------------------------------------------------------------
# Output writing with status
# ---------------------------------------------------------------------------

def write_outputs(outputs: dict[str, DataFrame], path: str, block_size, dims=None, level: int = 0,
                  args: dict | None = None, resolution=(1.0, 1.0, 1.0), factors: dict | None = None,
                  offset=(0.0, 0.0, 0.0), copy_from: tuple | None = None, attrs: dict | None = None,
                  cell_bits: int = volume.CELL_BITS) -> DataFrame:
    """Write every output and return their rows of the ledger.

    The ledger says 'running' before a write and 'complete' after it, with the true data type, the
    arguments, and what the write itself measured: extent, rows and largest label.  An output of
    one value (``.../max_id``) is not written: it stands for the max id where nothing was left to measure.
    A table without coordinates is written as plain Parquet beside the volumes.
    """
    spark = next(iter(outputs.values())).sparkSession
    ledger = led.Ledger(spark, path)
    rows = []
    for name, df in outputs.items():
        if len(df.columns) == 1:
            continue
        row = st.write_output(ledger, df, path, name, block_size, level, args, dims, (attrs or {}).get(name),
                              resolution=resolution, offset=offset, factors=(factors or {}).get(name), copy_from=copy_from,
                              cell_bits=cell_bits)
        top = outputs.get(f"{name}/max_id")
        if row["max_id"] is None and top is not None:
            row = ledger.complete(row, max_id=top.first()[0], rows=row["rows"])
        rows.append([row[f.name] for f in led.SCHEMA.fields])
    return spark.createDataFrame(rows, led.SCHEMA)


def write_pyramid(ms: DataFrame, path: str, factor_strings, block_sizes=None, max_entries=None, prev_block=64, group="pyramid",
                  args: dict | None = None) -> DataFrame:
    """P2 written: level ``i`` from the stored level ``i - 1``, with accumulated factors (B6) and entry cap
    in its attributes, and the group tagged as multiscale (D5).  Returns the levels' ledger rows."""
    spark = ms.sparkSession
    ledger = led.Ledger(spark, path)
    told = downsample_metadata(factor_strings, max_entries)
    factors = [attrs.parse_factors(s) for s in factor_strings]
    factors, blocks, caps = pyramid.normalise_pyramid_args(len(factors), factors, block_sizes, max_entries)
    prev = grid.triple(prev_block)
    st.write_output(ledger, ms, path, f"{group}/s0", prev_block, args=args)
    for i, (f, b) in enumerate(zip(factors, blocks), start=1):
        grid.check_factors(f, prev, b)
        prev = b
        below = volume.read_volume(spark, path, f"{group}/s{i - 1}")
        lv = pyramid.drop_empty_blocks(pyramid.downsample_multiset(below, f, caps[i - 1] if caps else -1), b)
        own = told[f"s{i}"]
        st.write_output(ledger, lv, path, f"{group}/s{i}", b, args=args, factors=own["factors"],
                        attrs={"maxNumEntries": own["max_entries"]}, copy_from=(f"{group}/s{i - 1}", 0))
    ledger.tag_multiscale(group)
    return ledger.latest().filter(F.col("dataset").startswith(f"{group}/"))


# ---------------------------------------------------------------------------
# Labels, multisets, unique labels, index
# ---------------------------------------------------------------------------

def convert_tool(labels: DataFrame, block_size=64, in_name="labels", out_name="multiset") -> dict:
    """A12 -> C3 -> C1 -> A4 (C2 as the max id)."""
    volume.check_preconditions(in_name, out_name, labels)
    ms = pyramid.drop_empty_blocks(convert.to_multiset(labels), block_size)
    return {out_name: ms, f"{out_name}/max_id": convert.max_id(labels)}


def downsample_tool(ms: DataFrame, factor_strings, block_sizes=None, max_entries=None,
                    prev_block=64) -> dict:
    """B8/B7 -> D3 -> D4 (levels s1..sn, each from the previous level, without
    empty blocks).  ``factors`` holds the accumulated factors of every level (B6)."""
    factors = [attrs.parse_factors(s) for s in factor_strings]
    factors, blocks, caps = pyramid.normalise_pyramid_args(len(factors), factors, block_sizes, max_entries)
    prev = grid.triple(prev_block)
    for f, b in zip(factors, blocks):
        grid.check_factors(f, prev, b)
        prev = b
    levels = pyramid.multiset_pyramid(ms, factors, caps)
    out = {"s0": ms}
    for i, lv in enumerate(levels[1:], start=1):
        out[f"s{i}"] = pyramid.drop_empty_blocks(lv, blocks[i - 1])
    return out


def downsample_metadata(factor_strings, max_entries=None) -> dict:
    """P2's level attributes: accumulated factors (B6) and entry cap, by level name."""
    factors = [attrs.parse_factors(s) for s in factor_strings]
    factors, _, caps = pyramid.normalise_pyramid_args(len(factors), factors, None, max_entries)
    out, acc = {}, None
    for i, f in enumerate(factors, start=1):
        acc = attrs.accumulate_factors(acc, f)
        out[f"s{i}"] = {"factors": tuple(acc), "max_entries": caps[i - 1] if caps else None}
    return out


def extract_unique_labels_tool(labels: DataFrame, block_size, multiset: bool = False,
                               mode: str = "argmax") -> dict:
    """A12 -> E1/E2, E3."""
    if multiset:
        u = unique.unique_labels_multiset(labels, block_size, mode)
        mx = unique.max_label(labels.select("label"))
    else:
        volume.check_preconditions("labels", "unique-labels", labels)
        u = unique.unique_labels(labels, block_size)
        mx = unique.max_label(labels)
    return {"unique-labels": u, "max_label": mx}


def downsample_unique_labels_tool(u: DataFrame, factor_strings, block_sizes, b0) -> dict:
    """E5."""
    factors = [attrs.parse_factors(s) for s in factor_strings]
    levels = unique.unique_label_pyramid(u, factors, block_sizes, b0)
    return {f"s{i}": lv for i, lv in enumerate(levels)}


def label_to_block_mapping_tool(levels: list[DataFrame], dims0, blocks, factors,
                                step: int = 1) -> dict:
    """P5: F1/F2 over every scale (F3), one job."""
    dims = [grid.triple(dims0)]
    for f in factors:
        dims.append(grid.downsampled_dims(dims[-1], f))
    return {"label-to-block-mapping": index.label_to_blocks_multiscale(levels, dims, blocks, step)}


# ---------------------------------------------------------------------------
# Watersheds with stitching
# ---------------------------------------------------------------------------

def stitched_stages(dims, block_size, seed_thr: float = -math.inf, merge_thr: float = 0.9, face_thr: float = -math.inf,
                    impassable_zero: bool = False, seeds: str = "all", merge_rule: str = "median", relabel: bool = True,
                    nan_value: float = -math.inf, relief: str = "relief", values: str | None = None) -> list[Stage]:
    """A7 -> H1/H2 -> H3 -> I3 -> I5/I6 -> I9 -> J1/J3 -> J6 -> J5 -> J9, from the frame named ``relief``.

    ``values``: the frame by which fragments and face contacts are merged (default: the relief).
    """
    d = grid.triple(dims)
    merge = {"median": stitch.merge_fragments_median, "min": stitch.merge_fragments_min}[merge_rule]
    by = "relief-clean" if values is None else "values-clean"

    def find_seeds(rel):
        mx = extrema.edge_only_maxima(rel, block_size, d, seed_thr) if seeds == "faces" else \
            extrema.local_maxima(rel, seed_thr, block_size)
        return extrema.seed_ids(mx, block_size)

    def merged(ws, v):
        return stitch.drop_singletons(stitch.merge_pairs_within_blocks(ws, merge(ws, v, block_size, merge_thr), block_size), block_size)

    def mapping(dense, v):
        e = stitch.merge_edges_median(dense, v, block_size, face_thr)
        return graph.connected_components(e.select("e1", "e2"), "e1", "e2")
    out = [Stage("relief-clean", (relief,), lambda r: affinity.replace_nan(r.select(*grid.AXES, "v"), "v", nan_value),
                 stored=False)]
    if values is not None:
        out.append(Stage("values-clean", (values,), lambda r: affinity.replace_nan(r.select(*grid.AXES, "v"), "v", -math.inf),
                         stored=False))
    out += [Stage("seeds", ("relief-clean",), find_seeds, {"threshold": seed_thr, "seeds": seeds}),
            Stage("seeded-watersheds", ("relief-clean", "seeds"), lambda rel, sid: segment.seeded_watershed(
                rel, sid.select(*grid.AXES, "seed"), d, block_size, impassable_zero)),
            Stage("merged", ("seeded-watersheds", by), merged, {"rule": merge_rule, "threshold": merge_thr})]
    if relabel:
        out += [Stage("relabelled", ("merged",), lambda m: stitch.relabel_dense(m, block_size, d), unique_ids=True),
                Stage("mapping", ("relabelled", by), mapping, {"threshold": face_thr}),
                Stage("block-merged", ("relabelled", "mapping"), lambda dense, m: stitch.apply_mapping(dense, m, keep_unmapped=True))]
    return out


def stitched_watersheds(relief: DataFrame, dims, block_size, seed_thr: float = -math.inf,
                        merge_thr: float = 0.9, face_thr: float = -math.inf,
                        impassable_zero: bool = False, seeds: str = "all",
                        merge_values: DataFrame | None = None, merge_rule: str = "median",
                        relabel: bool = True, nan_value: float = -math.inf) -> dict:
    """P6 (and P10-P12 given a distance-transform relief) as lazy frames; ``max_id`` is J10.

    ``merge_values``: the values by which fragments and face contacts are merged
    (default: the relief).  ``merge_rule``: ``median`` (I5) or ``min`` (I6).
    ``relabel=False`` stops after the merge inside blocks.
    """
    given = {"relief": relief} | ({} if merge_values is None else {"values": merge_values})
    out = st.compose(stitched_stages(dims, block_size, seed_thr, merge_thr, face_thr, impassable_zero, seeds, merge_rule,
                                     relabel, nan_value, values="values" if merge_values is not None else None), given)
    keep = ("seeds", "seeded-watersheds", "merged", "relabelled", "block-merged")
    out = {k: v for k, v in out.items() if k in keep}
    if relabel:
        out["max_id"] = stitch.max_label_id(out["block-merged"])
    return out


def dt_stages(dims, block_size, kind: str = "binary", thr: float = 0.9, weight: float = 0.01, resolution=(1.0, 1.0, 1.0),
              seed_dist: float = 0.0, seeds: str = "all", merge_thr: float = -math.inf, merge_rule: str = "median",
              relabel: bool = True) -> list[Stage]:
    """Distance-transform relief (H5 or H6) of the frame ``affinities``, then the P6 chain with
    relief 0 and NaN impassable; ``seeds='faces'`` seeds on block faces only (H2).
    Fragments and faces merge by the averaged affinities, not by distances."""
    def distances(aff):
        if kind == "binary":
            return distance.distance_transform_binary(aff, thr, dims, tuple(float(r) ** 2 for r in grid.triple(resolution)))
        return distance.distance_transform_sampled(aff, dims, distance.sampled_weights(resolution, weight))
    told = {"kind": kind, "resolution": list(grid.triple(resolution))} | ({"threshold": thr} if kind == "binary" else {"weight": weight})
    return [Stage("distance-transform", ("affinities",), distances, told)] + stitched_stages(
        dims, block_size, seed_dist, merge_thr, merge_thr, True, seeds, merge_rule, relabel, math.nan, "distance-transform", "affinities")


def dt_watersheds(aff_avg: DataFrame, dims, block_size, kind: str = "binary", thr: float = 0.9,
                  weight: float = 0.01, resolution=(1.0, 1.0, 1.0), seed_dist: float = 0.0,
                  seeds: str = "all", merge_thr: float = -math.inf, merge_rule: str = "median",
                  relabel: bool = True) -> dict:
    """``dt_stages`` as lazy frames."""
    out = st.compose(dt_stages(dims, block_size, kind, thr, weight, resolution, seed_dist, seeds, merge_thr, merge_rule, relabel),
                     {"affinities": aff_avg})
    if relabel:
        out["max_id"] = stitch.max_label_id(out["block-merged"])
    return out


# ---------------------------------------------------------------------------
# Masks and averaged affinities
# ---------------------------------------------------------------------------

def prediction_mask_tool(input_mask: DataFrame | None, out_extent: DataFrame | None, net_out_world,
                         in_res, out_res, in_off=(0, 0, 0), out_off=(0, 0, 0),
                         net_in_world=None, in_extent: DataFrame | None = None) -> dict:
    """Output block = network output size / output resolution; padding =
    half the network's input/output size difference (B14 -> G5).

    Without ``input_mask`` the input is 1 inside ``in_extent``.  Without ``out_extent`` the output covers
    the input's world size, snapped up to whole network outputs.
    """
    block = tuple(int(round(float(n) / float(r))) for n, r in zip(grid.triple(net_out_world), grid.triple(out_res)))
    if net_in_world is None:
        pad = (0.0, 0.0, 0.0)
    else:
        pad = tuple((float(i) - float(o)) / 2 for i, o in zip(grid.triple(net_in_world), grid.triple(net_out_world)))
    if in_extent is None and (input_mask is None or out_extent is None):
        if input_mask is None:
            raise ValueError("an input mask or its dims are required")
        in_extent = volume.extent(input_mask)
    if out_extent is None:
        out_extent = mask.snapped_extent(in_extent, in_res, out_res, net_out_world)
    if input_mask is None:
        return {"mask": mask.prediction_mask_dims(in_extent, out_extent, block, in_res, out_res, in_off, out_off, pad)}
    return {"mask": mask.prediction_mask(input_mask, out_extent, block, in_res, out_res, in_off, out_off, pad)}


def average_affinities_tool(aff: DataFrame, offset_specs=("-1,0,0", "0,-1,0", "0,0,-1"),
                            mask_df: DataFrame | None = None, glia: DataFrame | None = None,
                            glia_min=0.0, glia_max=1.0, glia_thr=float("nan"), nan_oob=False,
                            dims=None) -> dict:
    """B9 -> G2 -> G1 -> G3 -> G4.  Only the named channels are read, and the
    average is over as many offsets as are named."""
    chans = attrs.enumerate_offsets(offset_specs)
    place = F.create_map(*[F.lit(int(v)) for i, (c, _) in enumerate(chans) for v in (c, i)])
    a = (aff.filter(F.col("c").isin(*[c for c, _ in chans]))
            .withColumn("c", place[F.col("c").cast("int")].cast(aff.schema["c"].dataType)))
    return {"averaged": affinity.average_affinities(a, [o for _, o in chans], mask_df, glia, glia_min, glia_max,
                                                    glia_thr, nan_oob, dims)}


# ---------------------------------------------------------------------------
# Rain watershed;  P13: mutex watershed
# ---------------------------------------------------------------------------

def rain_stages(offsets, dims, block_size, thr: float = 0.9, min_aff: float = -math.inf, min_size: int = -1,
                invert: bool = False, relabel: bool = True) -> list[Stage]:
    """P9 from the frame ``affinities``: A8 -> G7 -> G6 -> I1 -> I2 -> I10 -> H4 -> I4 -> J1/J2.

    A basin's label is its root's voxel index plus 1, since 0 is background.
    With ``relabel`` all four label outputs get dense ids, block by block.
    """
    d = grid.triple(dims)
    raw = "raw-" if relabel else ""

    def valid(aff):
        return affinity.invalidate_cross_block(affinity.invert_channels(aff, len(offsets)) if invert else aff, offsets, block_size)

    def edges(a):
        return segment.voxel_edges(affinity.symmetric_affinities(a, offsets), affinity.symmetric_offsets(offsets), d, block_size, min_aff)

    def part(node):
        return segment.block_number(node, d, block_size)

    def labelled(basins):
        return segment._node_to_xyz(basins.select("node", (F.col("root") + 1).alias("label")), d)

    def merged(ws, e):
        return labelled(segment.merge_basins(ws.select(grid.linear_index(d).alias("node"), (F.col("label") - 1).alias("root")), e, thr, part))
    out = [Stage("valid", ("affinities",), valid, {"invert": invert}, stored=False),
           Stage("edges", ("valid",), edges, {"least": min_aff}),
           Stage(raw + "watersheds", ("valid", "edges"), lambda a, e: labelled(
               segment.steepest_ascent(a.select(grid.linear_index(d).alias("node")).distinct(), e, part))),
           Stage(raw + "merged", (raw + "watersheds", "edges"), merged, {"threshold": thr}),
           Stage(raw + "size-filtered", (raw + "merged",), lambda m: stitch.size_filter(m, block_size, min_size), {"least": min_size}),
           Stage("seeds", (raw + "size-filtered",), lambda m: extrema.boundary_seeds(m, offsets, d)),
           Stage(raw + "seeded", (raw + "size-filtered", "valid"), lambda m, a: segment.seeded_growth(m, a, offsets, d, block_size))]
    if relabel:
        out += [Stage(k, (raw + k,), lambda v: stitch.relabel_dense(v, block_size, d), unique_ids=True)
                for k in ("watersheds", "merged", "size-filtered", "seeded")]
    return out


def rain_tool(aff: DataFrame, offsets, dims, block_size, thr: float = 0.9, min_aff: float = -math.inf,
              min_size: int = -1, invert: bool = False, relabel: bool = True) -> dict:
    """``rain_stages`` as lazy frames: watersheds, merged, size-filtered, seeds, seeded."""
    out = st.compose(rain_stages(offsets, dims, block_size, thr, min_aff, min_size, invert, relabel), {"affinities": aff})
    return {k: out[k] for k in ("watersheds", "merged", "size-filtered", "seeded", "seeds")}


def mutex_stages(offsets, dims, block_size, mask: bool = False, glia: bool = False, thr: float | None = None,
                 keep_long: float = 0.01) -> list[Stage]:
    """P13 from the frames ``affinities``, ``mask`` and ``glia``: G8 -> I8 -> I7 -> I9 -> J1/J3 -> J7 -> J5 -> J9."""
    d = grid.triple(dims)
    more = tuple(n for n, there in (("mask", mask), ("glia", glia)) if there)

    def weighted(aff, *extra):
        got = dict(zip(more, extra))
        return affinity.weight_edges(aff, offsets, got.get("mask"), got.get("glia"))
    return [Stage("weighted", ("affinities", *more), weighted),
            Stage("mutex", ("weighted",), lambda a: stitch.drop_singletons(
                segment.mutex_segmentation(a, offsets, d, block_size, thr, keep_long), block_size),
                {"threshold": thr, "keep": keep_long}),
            Stage("relabelled", ("mutex",), lambda m: stitch.relabel_dense(m, block_size, d), unique_ids=True),
            Stage("mapping", ("relabelled",), lambda m: graph.connected_components(
                stitch.merge_edges_mutual_argmax(m, block_size), "e1", "e2")),
            Stage("merged", ("relabelled", "mapping"), lambda m, cc: stitch.apply_mapping(m, cc, True))]


def mutex_tool(aff: DataFrame, offsets, dims, block_size, mask_df: DataFrame | None = None,
               glia: DataFrame | None = None, thr: float | None = None, keep_long: float = 0.01) -> dict:
    """``mutex_stages`` as lazy frames: mutex, relabelled, merged."""
    given = {"affinities": aff} | {k: v for k, v in (("mask", mask_df), ("glia", glia)) if v is not None}
    out = st.compose(mutex_stages(offsets, dims, block_size, mask_df is not None, glia is not None, thr, keep_long), given)
    return {k: out[k] for k in ("mutex", "relabelled", "merged")}
