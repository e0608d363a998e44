"""Spark ML Estimator and Model over telemetry rows."""

from __future__ import annotations

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.ml.bundle import SERVING_TAG, load_function
from gaugeline.ml.scorers import DEFAULT_SIGNATURE, lookup
from gaugeline.operators.projections import output_mapping
from gaugeline.operators.scoring import BATCH_SIZE, score
from gaugeline.operators.windows import WINDOW_SIZE
from gaugeline.plans.forecast import predict_windows
from gaugeline.plans.gradient import fit_linear
from gaugeline.plans.training import lag_features


def _to_dict(value) -> dict:
    if isinstance(value, dict):
        return value
    raise TypeError(f"expected a dict, got {type(value).__name__}")


class WindowParams(Params):
    """Parameters shared by the estimator and the model it returns."""

    inputMapping = Param(
        Params._dummy(), "inputMapping", "input column -> model input", typeConverter=_to_dict
    )
    outputMapping = Param(
        Params._dummy(), "outputMapping", "model output -> output column", typeConverter=_to_dict
    )
    scaleBy = Param(
        Params._dummy(),
        "scaleBy",
        "model output -> input column whose scale restores it",
        typeConverter=_to_dict,
    )
    seriesCols = Param(
        Params._dummy(), "seriesCols", "columns naming a series",
        typeConverter=TypeConverters.toListString,
    )
    orderCols = Param(
        Params._dummy(), "orderCols", "columns ordering the rows of a series",
        typeConverter=TypeConverters.toListString,
    )
    timeCol = Param(
        Params._dummy(), "timeCol", "event time, for window_end",
        typeConverter=TypeConverters.toString,
    )
    windowSize = Param(
        Params._dummy(), "windowSize", "rows per window", typeConverter=TypeConverters.toInt
    )
    tail = Param(
        Params._dummy(), "tail", "short last windows: drop or reuse_previous",
        typeConverter=TypeConverters.toString,
    )
    scaling = Param(
        Params._dummy(), "scaling", "robust or none", typeConverter=TypeConverters.toString
    )
    inputShape = Param(
        Params._dummy(), "inputShape", "the model's view of one window, [windowSize] if not set",
        typeConverter=TypeConverters.toListInt,
    )
    batchSize = Param(
        Params._dummy(), "batchSize", "windows per model call", typeConverter=TypeConverters.toInt
    )
    epochs = Param(
        Params._dummy(), "epochs", "rounds of maxIter steps, for solver l-bfgs",
        typeConverter=TypeConverters.toInt,
    )
    maxIter = Param(
        Params._dummy(), "maxIter", "optimizer steps per epoch, for solver l-bfgs",
        typeConverter=TypeConverters.toInt,
    )
    solver = Param(
        Params._dummy(), "solver",
        "normal (exact, one pass), l-bfgs or gradient (maxIter * epochs steps; gradient keeps its state in modelDir)",
        typeConverter=TypeConverters.toString,
    )
    modelPath = Param(
        Params._dummy(), "modelPath", "saved model the scorer loads",
        typeConverter=TypeConverters.toString,
    )
    modelDir = Param(
        Params._dummy(), "modelDir", "shared folder of the training state; the latest one is gone on from",
        typeConverter=TypeConverters.toString,
    )
    exportDir = Param(
        Params._dummy(), "exportDir", "model bundle that holds the scoring function",
        typeConverter=TypeConverters.toString,
    )
    tagSet = Param(
        Params._dummy(), "tagSet", "tags of the bundle's variant, with commas",
        typeConverter=TypeConverters.toString,
    )
    signature = Param(
        Params._dummy(), "signature", "scoring function to call, registered or of the bundle",
        typeConverter=TypeConverters.toString,
    )
    args = Param(
        Params._dummy(), "args", "further arguments handed to the scorer", typeConverter=_to_dict
    )

    def _set_defaults(self) -> None:
        self._setDefault(
            inputMapping={},
            outputMapping={},
            scaleBy={},
            seriesCols=[],
            orderCols=[],
            windowSize=WINDOW_SIZE,
            tail="drop",
            scaling="robust",
            batchSize=BATCH_SIZE,
            epochs=1,
            maxIter=1000,
            solver="normal",
            signature=DEFAULT_SIGNATURE,
            tagSet=SERVING_TAG,
            args={},
        )

    def merged_args(self) -> dict:
        """``args`` overlaid with every parameter that has a value; parameters win."""
        values = {
            p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p) and p.name != "args"
        }
        return {**self.getOrDefault("args"), **values}

    def scorer_options(self) -> dict:
        options = self.merged_args()
        if self.isDefined("modelPath"):
            options["model_path"] = self.getOrDefault("modelPath")
        if self.getInputMapping():
            mapping = self.getInputMapping()
            options["inputs"] = [mapping[c] for c in sorted(mapping)]
        if self.getOutputMapping():
            options["outputs"] = sorted(self.getOutputMapping())
        return options

    def input_columns(self) -> list[str]:
        columns = sorted(self.getInputMapping())
        if not columns:
            raise ValueError("inputMapping names no column")
        return columns

    def scoring_function(self, spark):
        """The function of the bundle at ``exportDir``, or the name of a registered one."""
        if not self.isDefined("exportDir"):
            return self.getSignature()
        return load_function(spark, self.getExportDir(), self.getSignature(), self.getTagSet())

    def setInputMapping(self, value: dict):
        return self._set(inputMapping=value)

    def getInputMapping(self) -> dict:
        return self.getOrDefault("inputMapping")

    def setOutputMapping(self, value: dict):
        return self._set(outputMapping=value)

    def getOutputMapping(self) -> dict:
        return self.getOrDefault("outputMapping")

    def setScaleBy(self, value: dict):
        return self._set(scaleBy=value)

    def getScaleBy(self) -> dict:
        return self.getOrDefault("scaleBy")

    def setSeriesCols(self, value: list[str]):
        return self._set(seriesCols=value)

    def getSeriesCols(self) -> list[str]:
        return self.getOrDefault("seriesCols")

    def setOrderCols(self, value: list[str]):
        return self._set(orderCols=value)

    def getOrderCols(self) -> list[str]:
        return self.getOrDefault("orderCols")

    def setTimeCol(self, value: str):
        return self._set(timeCol=value)

    def getTimeCol(self) -> str | None:
        return self.getOrDefault("timeCol") if self.isDefined("timeCol") else None

    def setWindowSize(self, value: int):
        return self._set(windowSize=value)

    def getWindowSize(self) -> int:
        return self.getOrDefault("windowSize")

    def setTail(self, value: str):
        return self._set(tail=value)

    def getTail(self) -> str:
        return self.getOrDefault("tail")

    def setScaling(self, value: str):
        return self._set(scaling=value)

    def getScaling(self) -> str:
        return self.getOrDefault("scaling")

    def setInputShape(self, value: list[int]):
        return self._set(inputShape=value)

    def getInputShape(self) -> list[int]:
        return self.getOrDefault("inputShape") if self.isDefined("inputShape") else [self.getWindowSize()]

    def setBatchSize(self, value: int):
        return self._set(batchSize=value)

    def getBatchSize(self) -> int:
        return self.getOrDefault("batchSize")

    def setEpochs(self, value: int):
        return self._set(epochs=value)

    def getEpochs(self) -> int:
        return self.getOrDefault("epochs")

    def setMaxIter(self, value: int):
        return self._set(maxIter=value)

    def getMaxIter(self) -> int:
        return self.getOrDefault("maxIter")

    def setSolver(self, value: str):
        return self._set(solver=value)

    def getSolver(self) -> str:
        return self.getOrDefault("solver")

    def setModelPath(self, value: str):
        return self._set(modelPath=value)

    def getModelPath(self) -> str | None:
        return self.getOrDefault("modelPath") if self.isDefined("modelPath") else None

    def setModelDir(self, value: str):
        return self._set(modelDir=value)

    def getModelDir(self) -> str | None:
        return self.getOrDefault("modelDir") if self.isDefined("modelDir") else None

    def setExportDir(self, value: str):
        return self._set(exportDir=value)

    def getExportDir(self) -> str | None:
        return self.getOrDefault("exportDir") if self.isDefined("exportDir") else None

    def setTagSet(self, value: str):
        return self._set(tagSet=value)

    def getTagSet(self) -> str:
        return self.getOrDefault("tagSet")

    def setSignature(self, value: str):
        return self._set(signature=value)

    def getSignature(self) -> str:
        return self.getOrDefault("signature")

    def setArgs(self, value: dict):
        return self._set(args=value)

    def getArgs(self) -> dict:
        return self.getOrDefault("args")


class WindowForecastModel(Model, WindowParams, DefaultParamsReadable, DefaultParamsWritable):
    """Telemetry rows in, one prediction row per window out."""

    @keyword_only
    def __init__(self, **params):
        super().__init__()
        self._set_defaults()
        self._set(**params)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return predict_windows(
            dataset,
            self.getOrderCols(),
            self.input_columns(),
            self.getWindowSize(),
            self.getSeriesCols(),
            self.getTimeCol(),
            self.getTail(),
            self.getScaling(),
            self.getInputShape(),
            signature=self.scoring_function(dataset.sparkSession),
            outputs=self.getOutputMapping() or None,
            scale_by=self.getScaleBy(),
            batch_size=self.getBatchSize(),
            options=self.scorer_options(),
        )


class VectorModel(Model, WindowParams, DefaultParamsReadable, DefaultParamsWritable):
    """Rows with array columns in, the same rows with one column per mapped output out.

    ``inputMapping`` names the array columns, ``outputMapping`` the outputs; rows
    stay where they are, so there is no shuffle.
    """

    @keyword_only
    def __init__(self, **params):
        super().__init__()
        self._set_defaults()
        self._set(**params)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        signature, mapping = self.scoring_function(dataset.sparkSession), self.getOutputMapping()
        names = list(lookup(signature).outputs) or sorted(mapping)
        options = {**self.scorer_options(), "outputs": names}
        scored = score(
            dataset, self.input_columns(), signature, self.getOrDefault("inputShape"), "__out",
            self.getBatchSize(), options,
        )
        if len(names) == 1:
            scored = scored.withColumn("__out", F.struct(F.col("__out").alias(names[0])))
        return output_mapping(scored, mapping, "__out", keep=dataset.columns)


class WindowForecaster(Estimator, WindowParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the next value of the last mapped column on windows of all mapped columns.

    Training is one distributed least-squares fit; the coefficients (one per
    window position and input) are all that reaches the driver. With
    ``solver="gradient"`` and a ``modelDir`` the fit writes its state every epoch
    (``maxIter`` steps) and goes on from the latest one.
    """

    @keyword_only
    def __init__(self, **params):
        super().__init__()
        self._set_defaults()
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> WindowForecastModel:
        inputs = self.input_columns()
        examples = lag_features(
            dataset,
            self.getOrderCols(),
            inputs,
            inputs[-1],
            self.getWindowSize(),
            self.getSeriesCols(),
            self.getScaling(),
        )
        # The fit passes over the examples more than once; packed windows are an
        # eighth of the rows they came from.
        examples = examples.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
        steps = self.getMaxIter() * self.getEpochs()
        try:
            if self.getSolver() == "gradient":
                arrays = examples.select(vector_to_array("features").alias("features"), "label")
                state = fit_linear(arrays, steps, self.getMaxIter(), self.getModelDir())
                coefficients, intercept = state.weights[:-1], state.weights[-1]
            else:
                fitted = LinearRegression(solver=self.getSolver(), maxIter=steps, tol=1e-12).fit(examples)
                coefficients, intercept = [float(c) for c in fitted.coefficients], float(fitted.intercept)
        finally:
            examples.unpersist()
        model = self._copyValues(WindowForecastModel())
        return model.setSignature("linear").setArgs(
            {
                **self.getArgs(),
                "coefficients": coefficients,
                "intercept": intercept,
            }
        )
