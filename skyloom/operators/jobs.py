"""Jobs from folder to folder: what is done already is skipped, unreadable files are reported, files are committed at the end."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P
from ..sources import image_sink as S
from ..sources import images as I
from ..sources import work
from . import assets as A
from . import frames as FR
from . import models as M
from . import stages as G


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """(rel_path, parent, stem, suffix) of the images below a folder; none where it isn't there."""
    fs, root = S.located(folder)
    if fs.get_file_info(root).type.name == "NotFound":
        empty = spark.range(0).select(F.lit("").alias("rel_path"))
        p = F.col("rel_path")
        return empty.select("rel_path", P.parent(p).alias("parent"), P.stem(p).alias("stem"), P.suffix(p).alias("suffix"))
    p = F.col("rel_path")
    return I.inventory(spark, folder).select("rel_path", P.parent(p).alias("parent"), P.stem(p).alias("stem"), P.suffix(p).alias("suffix"))


def numbered(files: DataFrame) -> DataFrame:
    """``files`` with img, their place in the order of paths: the key of their frames in a job."""
    return work.cut(A.ranked(files, P.sort_key(F.col("rel_path"))).withColumn("img", F.col("_rank").cast("long")).drop("_rank", "_total"))


def read(spark: SparkSession, folder: str, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(frames, unreadable) of the numbered files below a folder: frames by img, and the rows of those that can't be decoded.

    Files are decoded once, and kept as bytes in the shared folder; without any nothing is read.
    """
    wanted = files.select(F.col("rel_path").alias("path"), "img")
    if files.isEmpty():
        images = spark.createDataFrame([], f"{S.SCHEMA}, img long")
    else:
        images = work.cut(S.read_images(spark, folder).join(wanted, "path"))
    return FR.from_bytes(images.where("height > 0"), F.col("img")), images.where("height <= 0").select("path", "img")


def _written(rows: DataFrame, folder: str, quality: int) -> None:
    """Rows of the sink, if there are any."""
    if not rows.isEmpty():
        S.write_images(rows, folder, quality)


def _output(parent: str, stem: str, ending: str):
    name = F.concat(F.col(stem), F.lit(ending))
    return F.when(F.col(parent) == "", name).otherwise(F.concat(F.col(parent), F.lit("/"), name))


def blur_folder(
    spark: SparkSession, source: str, target: str, slots: dict[str, M.Slot], n: int, least: dict[str, float], how: G.Blur = G.Blur(),
    annotate: bool = True, overwrite: bool = False, quality: int = 95,
) -> DataFrame:
    """Blurs the images of a folder: for each NAME.ext a NAME_blur.jpg and, with ``annotate``, a NAME_annot.jpg in the same place below ``target``.

    Images that have all their files already are left out, unless ``overwrite``.  Returns one row for each image that was tried: image,
    face_boxes, lp_boxes, total_boxes, blur_output, annot_output and error (unreadable files, failing models: no files).
    """
    endings = ["_blur.jpg", "_annot.jpg"] if annotate else ["_blur.jpg"]
    files = work.cut(listed(spark, source))
    if not overwrite:
        wanted = files.withColumn("out", F.explode(F.array(*[_output("parent", "stem", e) for e in endings])))
        have = listed(spark, target).select(F.col("rel_path").alias("out"))
        files = files.join(A.pending_all(wanted, have, "rel_path", "out"), "rel_path", "left_semi")
    files = numbered(files)
    frames, unreadable = read(spark, source, files)
    found = G.detections(G.cube_rows(frames, n), slots, n, least)
    done = work.cut(G.blurred(frames, found, n, how, annotate).join(files.select("img", "rel_path", "parent", "stem"), "img"))
    good = done.where("error IS NULL")
    parts = FR.as_bytes(good, _output("parent", "stem", "_blur.jpg"))
    if annotate:
        parts = parts.unionByName(FR.as_bytes(good.drop("data").withColumnRenamed("drawn", "data"), _output("parent", "stem", "_annot.jpg")))
    _written(parts, target, quality)
    made = lambda e: F.when(F.col("error").isNull(), _output("parent", "stem", e)).otherwise("")
    rows = done.select(
        F.col("rel_path").alias("image"), "face_boxes", "lp_boxes", (F.col("face_boxes") + F.col("lp_boxes")).alias("total_boxes"),
        made("_blur.jpg").alias("blur_output"), (made("_annot.jpg") if annotate else F.lit("")).alias("annot_output"), "error")
    zero = F.lit(0).cast("long")
    return rows.unionByName(unreadable.select(
        F.col("path").alias("image"), zero.alias("face_boxes"), zero.alias("lp_boxes"), zero.alias("total_boxes"), F.lit("").alias("blur_output"),
        F.lit("").alias("annot_output"), F.lit("unreadable").alias("error")))


def mask_folder(spark: SparkSession, source: str, target: str, whole: M.Slot, spots: M.Slot, how: G.Tiles = G.Tiles(), overwrite: bool = False) -> DataFrame:
    """Masks of the images of a folder as NAME.png in the same place below ``target``: (image, output, error) of those that were tried.

    Two images of a place that differ in their endings only have one mask: the first by path makes it, as a mask that is there is kept.
    """
    files = listed(spark, source).withColumn("output", _output("parent", "stem", ".png"))
    if not overwrite:
        files = A.pending(files, listed(spark, target).select(F.col("rel_path").alias("output")), "output")
    first = files.groupBy("output").agg(F.min(F.struct(P.sort_key(F.col("rel_path")).alias("k"), "rel_path")).alias("f")).select("output", "f.rel_path")
    files = numbered(files.drop("output").join(first, "rel_path"))
    frames, unreadable = read(spark, source, files)
    done = work.cut(G.tiled_masks(frames, whole, spots, how).join(files.select("img", "rel_path", "output"), "img"))
    _written(FR.as_bytes(done.where("error IS NULL"), F.col("output")), target, 95)
    return done.select(F.col("rel_path").alias("image"), "output", "error").unionByName(
        unreadable.join(files.select("img", "output"), "img").select(F.col("path").alias("image"), "output", F.lit("unreadable").alias("error")))


def finish_folder(
    spark: SparkSession, source: str, masks: str | None, target: str, hole: np.ndarray, inpaint: Callable[[np.ndarray, np.ndarray], np.ndarray],
    how: G.Finish = G.Finish(), edited: str = "_comfyui_carremoved", sky: str = "_comfyui_newsky", skip_existing: bool = True, quality: int = 85,
) -> DataFrame:
    """Finishes the images of a folder: (image, output).

    With ``masks``, images NAME + ``edited`` get the sky of NAME + ``sky`` beside them by the mask of NAME, and become NAME; a missing sky
    or mask fails the job before any work, as does a folder without edited images.  Without, all images are repaired under their names.
    What is there already is skipped, and then needs neither.
    """
    files = listed(spark, source)
    if masks is None:
        files = files.withColumn("base", F.col("stem"))
    else:
        stem = F.col("stem")
        files = files.where(stem.endswith(edited) & (F.length(stem) > len(edited))).withColumn("base", F.substring(stem, F.lit(1), F.length(stem) - len(edited)))
        if files.isEmpty():
            raise ValueError(f"no image of {source} ends with {edited}")
    name = F.concat("base", F.lower("suffix"))
    files = files.withColumn("output", F.col("rel_path") if masks is None else F.when(F.col("parent") == "", name).otherwise(F.concat_ws("/", "parent", name)))
    if skip_existing:
        files = A.pending(files, listed(spark, target).select(F.col("rel_path").alias("output")), "output")
    if masks is None:
        plan = files.select("rel_path", "output", F.lit(None).cast("string").alias("sky"), F.lit(None).cast("string").alias("mask"))
    else:
        wanted = files.select("rel_path", "parent", F.concat("base", F.lit(sky)).alias("stem"), "suffix")
        skies = A.siblings(wanted, listed(spark, source)).withColumnRenamed("sibling", "sky")
        found = A.resolve_masks(files.select("rel_path", "parent", F.col("base").alias("stem")), listed(spark, masks))
        plan = files.select("rel_path", "output").join(skies, "rel_path", "left").join(found, "rel_path", "left")
        lacking = plan.where("sky IS NULL OR mask IS NULL").select(F.concat(F.when(F.col("sky").isNull(), "no new sky for ").otherwise("no mask for "), "rel_path").alias("e")).sort("e").limit(21)
        errors = [r.e for r in lacking.collect()]
        if errors:
            raise ValueError("\n".join(errors[:20] + ["... and more"] * (len(errors) > 20)))
    # frames of all the files that a job needs, from both folders, under one numbering
    own = plan.select("rel_path").unionByName(plan.where("sky IS NOT NULL").select(F.col("sky").alias("rel_path"))).distinct().withColumn("folder", F.lit(0))
    named = plan.where("mask IS NOT NULL").select(F.col("mask").alias("rel_path")).distinct().withColumn("folder", F.lit(1))
    files = numbered(own.unionByName(named))
    parts = [read(spark, folder, files.where(F.col("folder") == k))[0] for k, folder in enumerate((source, masks)) if folder is not None]
    frames = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    place = lambda k, column, as_: files.where(F.col("folder") == k).select(F.col("rel_path").alias(column), F.col("img").alias(as_))
    jobs = work.cut(plan.join(place(0, "rel_path", "img"), "rel_path").join(place(0, "sky", "sky_img"), "sky", "left").join(place(1, "mask", "mask_img"), "mask", "left"))
    done = G.finished(jobs.select("img", F.col("sky_img").alias("sky"), F.col("mask_img").alias("mask")), frames, hole, inpaint, how)
    done = done.join(jobs.select("img", "output"), "img")
    _written(work.cut(FR.as_bytes(done, F.col("output"))), target, quality)
    return jobs.select(F.col("rel_path").alias("image"), "output")
