"""the feature pipeline as one Spark ML ``Pipeline`` (fit on train only, quirk Q3)."""

from __future__ import annotations

from pyspark.ml import Pipeline

from assay.functions.scalar import DERIVED_NAMES
from assay.operators import stages as ST


def feature_pipeline(features, segment: str | None, roles: dict, score: str = "score",
                     recode_map: dict | None = None, scale: str = "standard") -> Pipeline:
    """clip (IQR, per segment) -> derived ratios -> segment recode -> skew transforms ->
    scaling (population std) -> class targets.  The skew stage decides its output
    columns at fit time and the scaler is told to scale every numeric feature it sees,
    so the fitted pipeline is the stored output schema."""
    features = list(features)
    derived = list(DERIVED_NAMES)
    stages = [
        ST.OutlierHandler(inputCols=features, method="clip", segmentCol=segment),
        ST.DerivedRatios(roles=roles),
    ]
    if segment and recode_map:
        stages.append(ST.SegmentRecode(segmentCol=segment, mapping=recode_map))
    stages.append(_SkewThenScale(features + derived, scale))
    stages.append(ST.ScoreClasses(scoreCol=score))
    return Pipeline(stages=stages)


class _SkewThenScale(ST.Estimator):
    """Skew transforms, then scaling of the originals and every added column."""

    def __init__(self, cols, kind):
        super().__init__()
        self.cols, self.kind = list(cols), kind

    def _fit(self, df):
        from pyspark.ml import PipelineModel
        sk = ST.SkewTransformer(inputCols=self.cols).fit(df)
        out = sk.transform(df)
        sc = ST.ColumnScaler(inputCols=self.cols + sk.outputCols(), kind=self.kind).fit(out)
        return PipelineModel(stages=[sk, sc])
