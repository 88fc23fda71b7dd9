"""Name clean-up steps as ML pipeline stages."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark import keyword_only
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomina.functions import text


class TextStep(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A step that rewrites one text column; subclasses say how."""

    @keyword_only
    def __init__(self, *, inputCol: str = "name", outputCol: str = "name"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def rewrite(self, c: Column) -> Column:
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), self.rewrite(F.col(self.getInputCol())))


def _step(name: str, function: Callable[[Column], Column]) -> type[TextStep]:
    return type(name, (TextStep,), {"rewrite": lambda self, c: function(c), "__module__": __name__, "__doc__": function.__doc__})


LegalFormRemover = _step("LegalFormRemover", text.remove_legal_forms)
OrganisationSuffixRemover = _step("OrganisationSuffixRemover", text.remove_organisation_suffixes)
NumberRemover = _step("NumberRemover", text.remove_numbers)
NonWordRemover = _step("NonWordRemover", text.remove_non_words)
Transliterator = _step("Transliterator", text.transliterate)
Lowercaser = _step("Lowercaser", text.lowercase)


class EntityExtractor(TextStep):
    """Replaces a text by what a pluggable function finds in it; keeps it as it is by default.

    The function is kept by its importable name, so a saved stage has it when it is loaded.
    A function without such a name works until the stage is saved, which then fails.
    """

    functionName = Param(Params._dummy(), "functionName", "module:name of the function", TypeConverters.toString)
    function: Callable[[Column], Column] | None = None

    def using(self, function: Callable[[Column], Column]) -> EntityExtractor:
        self.function = function
        self._set(functionName=f"{function.__module__}:{function.__qualname__}")
        return self

    def rewrite(self, c: Column) -> Column:
        if self.function is None and self.isDefined(self.functionName):
            self.function = self._named()
        return c if self.function is None else self.function(c)

    def _named(self) -> Callable[[Column], Column]:
        module, name = self.getOrDefault(self.functionName).split(":")
        found = importlib.import_module(module)
        for part in name.split("."):
            found = getattr(found, part)
        return found

    def write(self) -> MLWriter:
        if self.isDefined(self.functionName):
            try:
                self._named()
            except (AttributeError, ImportError) as missing:
                raise ValueError(f"{self.getOrDefault(self.functionName)} cannot be imported, so the stage cannot be saved") from missing
        return super().write()


STEPS = (
    EntityExtractor,
    LegalFormRemover,
    OrganisationSuffixRemover,
    NumberRemover,
    NonWordRemover,
    Transliterator,
    Lowercaser,
)


def normalization_pipeline(input_col: str = "name", output_col: str = "name") -> Pipeline:
    """All steps in order; Spark collapses them into one projection."""
    stages = [step(inputCol=input_col if i == 0 else output_col, outputCol=output_col) for i, step in enumerate(STEPS)]
    return Pipeline(stages=stages)
