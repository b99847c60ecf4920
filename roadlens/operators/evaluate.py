"""Comparison of predictions with ground truth and of backends, precision, recall and average precision, latency."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.geometry import centre_to_corners, iou, pixel
from roadlens.functions.text import is_float, stripped_lines, to_float, tokens
from roadlens.operators.ranks import running
from roadlens.session import materialize

#: IoU thresholds of the averaged metric.
IOU_GRID = [0.5 + 0.05 * i for i in range(10)]


def count_tags(images: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """(image_id, n_gt, n_pred, tag): fewer predictions than truth, more, or neither; images without a label have 0."""
    gt = truth.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_gt"))
    pred = predicted.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_pred"))
    out = images.select("image_id").join(gt, "image_id", "left").join(pred, "image_id", "left").fillna(0, ["n_gt", "n_pred"])
    tag = F.when(F.col("n_pred") < F.col("n_gt"), "_LIKELY_FN").when(F.col("n_pred") > F.col("n_gt"), "_LIKELY_FP").otherwise("")
    return out.withColumn("tag", tag)


def tag_summary(tagged: DataFrame) -> DataFrame:
    """Images of each tag."""
    return tagged.groupBy("tag").agg(F.count(F.lit(1)).alias("images"))


def flagged(tagged: DataFrame, images: DataFrame) -> DataFrame:
    """(tag, file_name, drawn_name): images to look at, with the name of their comparison picture."""
    drawn = F.concat("stem", "tag", F.lit(".jpg"))
    return tagged.where("tag <> ''").join(images.select("image_id", "file_name", "stem"), "image_id").select("tag", "file_name", drawn.alias("drawn_name"))


def truth_boxes(images: DataFrame, labels: DataFrame) -> DataFrame:
    """(image_id, kind, x1, y1, x2, y2, caption): whole pixels of the label lines of five tokens with finite numbers, to be drawn."""
    own = labels.join(images.select("split", "stem", "image_id", "width", "height"), ["split", "stem"])
    lines = own.select("image_id", "width", "height", F.explode(stripped_lines(F.col("body"))).alias("line")).withColumn("tok", tokens(F.col("line")))
    whole = lines.where((F.size("tok") == 5) & F.forall(F.slice("tok", 2, 4), is_float))
    boxes = whole.select("image_id", "width", "height", *centre_to_corners(*[to_float(F.get("tok", F.lit(i))) for i in range(1, 5)]))
    corners = [pixel(F.col(c), F.col("width" if c[0] == "x" else "height")).alias(c) for c in ("x1", "y1", "x2", "y2")]
    return boxes.select("image_id", F.lit("truth").alias("kind"), *corners, F.lit("").alias("caption")).dropna(subset=["x1", "y1", "x2", "y2"])


def predicted_boxes(detections: DataFrame) -> DataFrame:
    """The same of detections in pixels, captioned with their confidence."""
    corners = [F.col(c).cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")]
    return detections.select("image_id", F.lit("predicted").alias("kind"), *corners, F.format_string("%.2f", F.col("confidence")).alias("caption"))


def draw_list(images: DataFrame, truth: DataFrame, predicted: DataFrame | None = None, n: int = 25, seed: int = 42) -> DataFrame:
    """What to draw on a seeded sample of n images: truth alone is an overlay, with predictions a comparison."""
    from roadlens.operators.sampling import seeded_sample

    chosen = seeded_sample(images, n, "file_name", seed).select("image_id", "file_name")
    boxes = truth if predicted is None else truth.unionByName(predicted)
    return boxes.join(F.broadcast(chosen), "image_id")  # n images, a parameter


def report(matched: DataFrame, n_truth: int, runs: DataFrame, confidence: float = 0.35) -> DataFrame:
    """One row: confidence_threshold, precision and recall at 0.5, map50, map50_95, avg_ms, fps and latency_sample.

    ``matched``, of ``match`` or ``match_steps``, is over IOU_GRID; average precision
    reads all predictions, the others those of the confidence threshold or above.
    """
    own = materialize(steps(matched))  # read by several aggregates
    ap = average_precision(own, n_truth)
    means = ap.agg(F.max(F.when(F.col("threshold") == IOU_GRID[0], F.col("ap"))).alias("map50"), F.avg("ap").alias("map50_95"))
    confident = own.where((F.col("threshold") == IOU_GRID[0]) & (F.col("confidence") >= confidence))
    rates = confident.agg(F.try_divide(F.sum("t").cast("double"), F.sum("n")).alias("precision"), F.try_divide(F.sum("t").cast("double"), F.lit(n_truth)).alias("recall"))
    held = latency(runs).withColumnRenamed("n", "latency_sample")
    one = lambda df: df.withColumn("__one", F.lit(1))
    whole = one(rates).join(one(means), "__one").join(one(held), "__one").drop("__one")  # a row each
    return whole.withColumn("confidence_threshold", F.lit(float(confidence)))


def parity(one: DataFrame, two: DataFrame, ties: list[str], conf_tol: float = 0.05, box_tol: float = 0.03) -> DataFrame:
    """By image: counts, greatest confidence, box and relative box difference of boxes paired by rank, and the verdict.

    Boxes are paired only where both backends found as many. The relative difference
    is to the smaller side of the first backend's box, one pixel at least.
    """
    def ranked(d: DataFrame, p: str) -> DataFrame:
        w = Window.partitionBy("image_id").orderBy(F.desc("confidence"), "x1", "y1", "x2", "y2", *ties)
        n = F.count(F.lit(1)).over(Window.partitionBy("image_id"))
        return d.select("image_id", F.row_number().over(w).alias("rank"), n.alias(f"n_{p}"), *[F.col(c).alias(f"{c}_{p}") for c in ("confidence", "x1", "y1", "x2", "y2")])

    both = ranked(one, "a").join(ranked(two, "b"), ["image_id", "rank"], "full")
    c = F.col
    same = (c("n_a") == c("n_b")) & c("confidence_a").isNotNull() & c("confidence_b").isNotNull()
    box = F.greatest(*[F.abs(c(f"{k}_a") - c(f"{k}_b")) for k in ("x1", "y1", "x2", "y2")])
    side = F.greatest(F.lit(1.0), F.least(c("x2_a") - c("x1_a"), c("y2_a") - c("y1_a")))
    out = both.groupBy("image_id").agg(
        F.coalesce(F.max("n_a"), F.lit(0)).alias("n_a"), F.coalesce(F.max("n_b"), F.lit(0)).alias("n_b"),
        F.coalesce(F.max(F.when(same, F.abs(c("confidence_a") - c("confidence_b")))), F.lit(0.0)).alias("conf_diff"),
        F.coalesce(F.max(F.when(same, box)), F.lit(0.0)).alias("box_diff"),
        F.coalesce(F.max(F.when(same, box / side)), F.lit(0.0)).alias("rel_diff"),
    )
    return out.withColumn("ok", (c("n_a") == c("n_b")) & (c("rel_diff") <= box_tol) & (c("conf_diff") <= conf_tol))


def _hits(truth: DataFrame, predicted: DataFrame, thresholds: list[float], ties: list[str]) -> DataFrame:
    """(image_id, p, hits): a frame's predictions in their order, and for each threshold an array with 1 where one finds a truth box.

    Where no prediction reaches two truth boxes and none is reached by two, at the least
    of the thresholds, a prediction's greatest overlap says all; other frames are folded
    threshold by threshold.
    """
    gt = truth.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("gt_id", "x1", "y1", "x2", "y2"))).alias("g"))
    pred = predicted.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("neg"), "x1", "y1", "x2", "y2", *ties))).alias("p"))
    both = pred.join(gt, "image_id", "left").withColumn("g", F.coalesce("g", F.expr("cast(array() as array<struct<gt_id:int,x1:double,y1:double,x2:double,y2:double>>)") if dict(truth.dtypes)["gt_id"] == "int" else F.slice("g", 1, 0)))
    # Overlaps are worked out once, whatever the number of thresholds.
    both = both.select("image_id", "p", F.transform("p", lambda x: F.transform(F.coalesce("g", F.array()), lambda b: iou(x, b))).alias("rows"))
    empty = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast("array<int>").alias("hits"))
    overlaps = lambda s, x: F.transform(x, lambda v, i: F.struct(F.when(F.array_contains(s["used"], i + 1), F.lit(-1.0)).otherwise(v).alias("o"), (-i).alias("ni")))

    def step(t):
        def run(s, x):
            best = F.array_max(overlaps(s, x))
            hit = F.coalesce(best["o"] >= t, F.lit(False))
            return F.struct(
                F.when(hit, F.concat(s["used"], F.array((1 - best["ni"]).cast("int")))).otherwise(s["used"]).alias("used"),
                F.concat(s["hits"], F.array(hit.cast("int"))).alias("hits"),
            )

        return run

    least = float(min(thresholds))
    both = both.withColumn("best", F.transform("rows", lambda v: F.array_max(v)))
    reached = F.filter("rows", lambda v: F.coalesce(F.array_max(v) >= least, F.lit(False)))
    both = both.withColumn("reached", F.transform(reached, lambda v: F.array_position(v, F.array_max(v))))
    alone = (F.size(F.array_distinct("reached")) == F.size("reached")) & F.forall("rows", lambda v: F.size(F.filter(v, lambda o: o >= least)) <= 1)
    levels = F.array(*[F.lit(float(t)) for t in thresholds])
    plain = F.transform(levels, lambda t: F.transform("best", lambda o: F.coalesce(o >= t, F.lit(False)).cast("int")))
    folded = F.transform(levels, lambda t: F.aggregate("rows", empty, step(t))["hits"])
    return both.select("image_id", "p", F.when(alone, plain).otherwise(folded).alias("hits"))


def match(truth: DataFrame, predicted: DataFrame, thresholds: list[float] | None = None, ties: list[str] | None = None) -> DataFrame:
    """(threshold, image_id, confidence, *ties, tp): greedy matching of a frame's predictions by falling confidence.

    Each takes the unused truth box of most overlap, if that reaches the threshold.
    ``truth`` has x1..y2 and a total order ``gt_id`` within its frame. The boxes of one
    frame are gathered in one row: hundreds as detectors give them.
    """
    ties, thresholds = ties or [], thresholds or [0.5]
    each = F.arrays_zip(F.array(*[F.lit(float(t)) for t in thresholds]).alias("threshold"), F.col("hits"))
    folded = _hits(truth, predicted, thresholds, ties).select("image_id", "p", F.explode(each).alias("e")).select("image_id", "p", "e.threshold", "e.hits")
    rows = folded.select("threshold", "image_id", F.explode(F.arrays_zip("p", "hits")).alias("z"))
    return rows.select("threshold", "image_id", (-F.col("z.p.neg")).alias("confidence"), *[F.col(f"z.p.{t}").alias(t) for t in ties], F.col("z.hits").alias("tp"))


def match_steps(truth: DataFrame, predicted: DataFrame, thresholds: list[float] | None = None, ties: list[str] | None = None) -> DataFrame:
    """``steps`` of ``match``, with no row for each threshold of a prediction: the thresholds' hits are summed side by side."""
    thresholds = thresholds or [0.5]
    names = [f"t{i}" for i in range(len(thresholds))]
    own = _hits(truth, predicted, thresholds, ties or []).select(F.col("p.neg").alias("neg"), *[F.get("hits", F.lit(i)).alias(n) for i, n in enumerate(names)])
    sums = own.select(F.explode(F.arrays_zip("neg", *names)).alias("z")).select("z.*").groupBy("neg").agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names])
    each = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(n).alias("t")) for t, n in zip(thresholds, names, strict=True)])).alias("e")
    return sums.select((-F.col("neg")).alias("confidence"), "n", each).select("e.threshold", "confidence", "n", "e.t")


def steps(matched: DataFrame) -> DataFrame:
    """(threshold, confidence, n, t): predictions of one confidence and how many of them are true; what has these columns stays as it is."""
    if {"n", "t"} <= set(matched.columns):
        return matched.select("threshold", "confidence", "n", "t")
    return matched.groupBy("threshold", "confidence").agg(F.count(F.lit(1)).alias("n"), F.sum("tp").alias("t"))


def precision_recall(matched: DataFrame, n_truth: int) -> DataFrame:
    """(threshold, predictions, tp, precision, recall)."""
    out = matched.groupBy("threshold").agg(F.count(F.lit(1)).alias("predictions"), F.sum("tp").alias("tp"))
    return out.withColumn("precision", F.try_divide(F.col("tp").cast("double"), F.col("predictions"))).withColumn("recall", F.try_divide(F.col("tp").cast("double"), F.lit(n_truth)))


def average_precision(matched: DataFrame, n_truth: int) -> DataFrame:
    """(threshold, ap): mean over 101 recall points of the greatest precision at that recall or beyond.

    Predictions, of ``match`` or ``match_steps``, are ranked by confidence through counts:
    those of one confidence form one step of the curve, so ties don't depend on order.
    The steps of a threshold are summed range by range of confidence: no task holds all
    of them.
    """
    own = steps(matched).select("threshold", (-F.col("confidence")).alias("neg"), F.col("n").alias("own_n"), F.col("t").alias("own_t"))
    curve = running(own, ["threshold"], [F.col("neg")], {"n": F.col("own_n"), "t": F.col("own_t")})
    curve = curve.select("threshold", (F.col("t").cast("double") / F.col("n")).alias("precision"), F.floor(F.col("t") * 100 / F.lit(n_truth)).cast("int").alias("reach"))
    points = curve.groupBy("threshold", "reach").agg(F.max("precision").alias("p"))
    later = Window.partitionBy("threshold").orderBy(F.desc("reach"))
    best = points.select("threshold", "reach", F.max("p").over(later).alias("p"), F.coalesce(F.lag("reach").over(Window.partitionBy("threshold").orderBy("reach")), F.lit(-1)).alias("before"))
    return best.groupBy("threshold").agg((F.sum(F.col("p") * (F.col("reach") - F.col("before"))) / 101).alias("ap"))


def latency(runs: DataFrame, column: str = "elapsed_ms") -> DataFrame:
    """Runs, mean milliseconds and images a second; null without runs."""
    return runs.agg(F.count(column).alias("n"), F.avg(column).alias("avg_ms")).withColumn("fps", F.try_divide(F.lit(1000.0), F.col("avg_ms")))
