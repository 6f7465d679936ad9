"""Fitted transforms that can be saved and loaded, alone or inside a ``Pipeline``.

Each is an ``Estimator`` whose ``Model`` keeps what it learnt as tables: codes of any number of
levels, scales, names of positions.  ``save`` writes the parameters as Spark ML does and every table
as Parquet beside them, so fitted state never passes through the driver whole and a
``PipelineModel`` that holds such stages is saved and loaded like any other.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import encode
from tessera.operators.scale import apply_standard, fit_standard
from tessera.session import cut_lineage


class _TableWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"tables": sorted(self.instance.tables)})
        for name, table in self.instance.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.tables = {name: self.sparkSession.read.parquet(f"{path}/tables/{name}") for name in metadata["tables"]}
        return model


class _TableModel(Model, MLWritable, MLReadable):
    """A model whose fitted state is ``tables``: name -> DataFrame."""

    def __init__(self, tables: dict[str, DataFrame] | None = None):
        super().__init__()
        self.tables = tables or {}

    def write(self) -> _TableWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> _TableReader:
        return _TableReader(cls)


def _vector(places: list[Column], numbers: list[Column], first: int) -> Column:
    """A vector of ones at ``places`` (NULL: none) and ``numbers`` from place ``first`` on; sparse or dense, whichever is smaller."""
    size = first + len(numbers)

    @F.udf(VectorUDT())
    def build(ones, plain):
        at = [p for p in ones if p is not None]
        values = [1.0] * len(at)
        for i, x in enumerate(plain):
            if x != 0.0:
                at.append(first + i)
                values.append(x)
        if 1.5 * (len(at) + 1) < size:
            return SparseVector(size, at, values)
        dense = [0.0] * size
        for p, x in zip(at, values):
            dense[p] = x
        return DenseVector(dense)

    return build(F.array(*places).cast("array<int>"), F.array(*numbers).cast("array<double>"))


class _CodeParams(Params):
    inputCol = Param(Params._dummy(), "inputCol", "column of labels", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "column of codes", TypeConverters.toString)


class LabelCodes(Estimator, _CodeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Codes 0..k-1 of the sorted labels; NULL and unknown labels get NULL."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> LabelCodesModel:
        codes = encode.fit_codes(df, self.getOrDefault("inputCol"))
        return self._copyValues(LabelCodesModel({"codes": cut_lineage(codes)}))


class LabelCodesModel(_TableModel, _CodeParams):
    """Fitted by ``LabelCodes``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return encode.label_encode(df, self.getOrDefault("inputCol"), self.tables["codes"], self.getOrDefault("outputCol"))

    def decode(self, df: DataFrame, code_col: str, out: str) -> DataFrame:
        """H2: the label of a code; NULL for codes that were not fitted."""
        return encode.label_decode(df, code_col, self.tables["codes"], out)


def _columns(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toListString)


class _MatrixParams(Params):
    oneHotCols = _columns("oneHotCols", "one place per level, NULL among them")
    dummyCols = _columns("dummyCols", "one place per level but the first")
    ordinalCols = _columns("ordinalCols", "place in sorted order")
    scaledCols = _columns("scaledCols", "centred and scaled")
    passthrough = _columns("passthrough", "taken as they are")
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "number of places of each one-hot and dummy column", TypeConverters.toListInt)

    def __init__(self):
        super().__init__()
        self._setDefault(oneHotCols=[], dummyCols=[], ordinalCols=[], scaledCols=[], passthrough=[], outputCol="features", sizes=[])

    def _blocks(self) -> list[tuple[str, str]]:
        return [(g, c) for g, p in (("onehot", "oneHotCols"), ("dummies", "dummyCols")) for c in self.getOrDefault(p)]

    def _plain(self) -> list[tuple[str, str]]:
        return [(g, f"{c}{suffix}") for g, p, suffix in (("ordinal", "ordinalCols", "_ord"), ("scaled", "scaledCols", "_z"), ("passthrough", "passthrough", ""))
                for c in self.getOrDefault(p)]


class FeatureMatrix(Estimator, _MatrixParams, DefaultParamsReadable, DefaultParamsWritable):
    """H6: one vector column from one-hot, dummy, ordinal, scaled and plain columns.

    One-hot blocks are sparse and hold any number of levels.  Unseen levels (for dummies the first
    level and NULL too) are all zeros, an unseen ordinal value or a missing number is NaN in the vector.
    """

    @keyword_only
    def __init__(self, *, oneHotCols=None, dummyCols=None, ordinalCols=None, scaledCols=None, passthrough=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FeatureMatrixModel:
        tables, sizes = {}, []
        for i, (group, c) in enumerate(self._blocks()):
            tables[f"levels_{i}"], size = encode.fit_levels(df, c, group == "dummies")
            sizes.append(size)
        for i, c in enumerate(self.getOrDefault("ordinalCols")):
            tables[f"ordinal_{i}"] = cut_lineage(encode.fit_codes(df, c))
        if self.getOrDefault("scaledCols"):
            tables["scales"] = cut_lineage(fit_standard(df, self.getOrDefault("scaledCols")))
        return self._copyValues(FeatureMatrixModel(tables))._set(sizes=sizes)


class FeatureMatrixModel(_TableModel, _MatrixParams):
    """Fitted by ``FeatureMatrix``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        cur, places, at = df, [], 0
        for i, ((group, c), size) in enumerate(zip(self._blocks(), self.getOrDefault("sizes"))):
            if size:
                cur = encode.levels_place(cur, c, self.tables[f"levels_{i}"], f"__place_{i}", group == "dummies")
                places.append(F.col(f"__place_{i}") + at)
                at += size
        for i, c in enumerate(self.getOrDefault("ordinalCols")):
            cur = encode.label_encode(cur, c, self.tables[f"ordinal_{i}"], out=f"{c}_ord")
        scaled = self.getOrDefault("scaledCols")
        if scaled:
            cur = apply_standard(cur, self.tables["scales"], scaled, suffix="_z")
        numbers = [F.coalesce(F.col(f"`{n}`").cast("double"), F.lit(float("nan"))) for _, n in self._plain()]
        vec = _vector(places, numbers, at).alias(self.getOrDefault("outputCol"), metadata={"ml_attr": {"num_attrs": at + len(numbers)}})
        return cur.select(*[f"`{c}`" for c in df.columns], vec)

    def names(self) -> DataFrame:
        """H7: ``(position, group, name)`` of the vector's places."""
        parts, at = [], 0
        for i, ((group, c), size) in enumerate(zip(self._blocks(), self.getOrDefault("sizes"))):
            if size:
                name = F.concat(F.lit(f"{c}_"), F.coalesce("value", F.lit(encode.NULL_LEVEL)))
                parts.append(self.tables[f"levels_{i}"].select((F.col("idx") + at).cast("int").alias("position"), F.lit(group).alias("group"), name.alias("name")))
                at += size
        plain = [(at + i, g, n) for i, (g, n) in enumerate(self._plain())]
        out = SparkSession.active().createDataFrame(plain, "position int, group string, name string")
        for p in parts:
            out = out.unionByName(p)
        return out
