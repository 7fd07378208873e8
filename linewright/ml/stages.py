"""The feature pipeline as MLlib stages, fitted on training rows and saved with the model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    ChiSqSelector,
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    UnivariateFeatureSelector,
    VarianceThresholdSelector,
    VectorAssembler,
)
from pyspark.sql import DataFrame

from ..operators.dataset import Routes
from ..operators.prep import VARIANCE_THRESHOLD

FEATURES = "features_scaled"
TOP_FEATURES = 40  # fixed value: features kept by the test-based selectors


def _expressions(expressions: dict[str, str]) -> SQLTransformer:
    listed = ", ".join(f"{sql} AS `{name}`" for name, sql in expressions.items())
    return SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__")


def preparation(
    routes: Routes,
    derived: dict[str, str] | None = None,
    complete: tuple[str, ...] = (),
    strategy: str = "median",
    variance: float = VARIANCE_THRESHOLD,
    with_mean: bool = False,
    with_std: bool = True,
) -> list:
    """Impute, cast flags, derive, index, one-hot, assemble, drop near-constant features, scale.

    ``derived`` names SQL expressions over the raw columns; ``complete`` lists numeric columns
    that are never NULL and skip imputation. Stages without columns are left out.
    """
    imputed = [c for c in routes.numeric if c not in complete]
    parts = [f"{c}_imp" for c in imputed] + [c for c in routes.numeric if c in complete]
    stages: list = []
    if imputed:
        stages.append(Imputer(inputCols=imputed, outputCols=[f"{c}_imp" for c in imputed], strategy=strategy))
    if routes.boolean:
        stages.append(_expressions({f"{c}_dbl": f"coalesce(CAST(`{c}` AS DOUBLE), 0.0D)" for c in routes.boolean}))
        parts += [f"{c}_dbl" for c in routes.boolean]
    if routes.categorical:
        indexed = [f"{c}_idx" for c in routes.categorical]
        encoded = [f"{c}_ohe" for c in routes.categorical]
        stages.append(
            StringIndexer(
                inputCols=routes.categorical,
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="frequencyDesc",
            )
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep", dropLast=True))
        parts += encoded
    if derived:
        stages.insert(1 if imputed else 0, _expressions(derived))
        parts += list(derived)
    return [
        *stages,
        VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="error"),
        VarianceThresholdSelector(featuresCol="features", outputCol="features_selected", varianceThreshold=variance),
        StandardScaler(inputCol="features_selected", outputCol=FEATURES, withMean=with_mean, withStd=with_std),
    ]


def chi_square_selector(label: str, top: int = TOP_FEATURES) -> ChiSqSelector:
    """Top features by chi-square; all features must be categories."""
    return ChiSqSelector(featuresCol="features", outputCol="features_chi", labelCol=label, numTopFeatures=top)


def anova_selector(label: str, top: int = TOP_FEATURES) -> UnivariateFeatureSelector:
    """Top continuous features by F-test against a class label."""
    selector = UnivariateFeatureSelector(
        featuresCol="features", outputCol="features_anova", labelCol=label, selectionMode="numTopFeatures"
    )
    return selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(top)


def vector_names(df: DataFrame, column: str = "features") -> list[str]:
    """The names of a vector's entries, from the column's metadata."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"]
    named = sorted((a["idx"], a["name"]) for group in groups.values() for a in group)
    return [name for _, name in named]


def selected_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """The names of the features that reach the classifier."""
    stage = next(s for s in model.stages if hasattr(s, "selectedFeatures"))
    names = vector_names(model.transform(df.limit(0)))
    return [names[i] for i in stage.selectedFeatures]
