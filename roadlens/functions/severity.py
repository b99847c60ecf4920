"""Per-frame severity as column expressions; a scorer may be swapped for another of the same outputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions.geometry import area_fraction, vertical_fraction


@dataclass(frozen=True)
class SeverityScorer:
    """Fixed values of the severity rules."""

    minor_area: float = 0.01
    moderate_area: float = 0.04
    extra_bonus: float = 0.08
    low_bonus: float = 0.15
    minor_score: float = 0.3
    moderate_score: float = 0.6

    def score(self, area: Column, vpos: Column, n: Column) -> Column:
        return F.least(F.lit(1.0), area * 10 + F.lit(self.extra_bonus) * (n - 1) + F.lit(self.low_bonus) * vpos)

    def label(self, area: Column, score: Column) -> Column:
        return (
            F.when((area < self.minor_area) & (score < self.minor_score), "minor")
            .when((area < self.moderate_area) & (score < self.moderate_score), "moderate")
            .otherwise("severe")
        )

    def reasons(self, area: Column, vpos: Column, n: Column) -> Column:
        """The wording of the reasons."""
        bonus, low = F.lit(self.extra_bonus) * (n - 1), F.lit(self.low_bonus) * vpos
        return F.array_compact(
            F.array(
                F.format_string("bbox covers %.2f%% of frame area", area * 100),
                F.when(n > 1, F.format_string("%d potholes detected in same frame (+%.2f)", n, bonus)),
                F.when(low > 0.01, F.format_string("positioned low in frame, likely closer to camera (+%.2f)", low)),
            )
        )


#: Fixed value: the caveat that every estimate carries.
CAVEAT = (
    "Severity is a heuristic estimate from bounding-box geometry and frame context only. It is not a physical measurement of depth, "
    "diameter, or volume — this system has no camera calibration or depth sensing. Do not use this as the sole basis for prioritizing "
    "repairs; use it to help triage for human review."
)


def score_frames(detections: DataFrame, frame: str = "image_id", scorer: SeverityScorer | None = None) -> DataFrame:
    """Adds n_in_frame, area_frac, vpos, severity_score and severity to x1, y1, x2, y2, width, height.

    One shuffle, on the frame, for the count of its detections.
    """
    scorer = scorer or SeverityScorer()
    n = F.count(F.lit(1)).over(Window.partitionBy(frame))
    c = F.col
    out = (
        detections.withColumn("n_in_frame", n)
        .withColumn("area_frac", area_fraction(c("x1"), c("y1"), c("x2"), c("y2"), c("width"), c("height")))
        .withColumn("vpos", vertical_fraction(c("y1"), c("y2"), c("height")))
    )
    out = out.withColumn("severity_score", scorer.score(c("area_frac"), c("vpos"), c("n_in_frame")))
    return out.withColumn("severity", scorer.label(c("area_frac"), c("severity_score")))
