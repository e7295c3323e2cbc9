"""Category encoding and feature vectors.

The vocabulary of a category column is the one thing we collect: its distinct
values, one column each in the wide 0/1 table. ``max_levels``, if given, makes
a wider column an error instead. For columns of many levels prefer
``one_hot_vector`` (sparse vector, no wide schema, nothing collected here).
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from functools import reduce

from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vocabulary(df: DataFrame, col: str, max_levels: int | None = None) -> list:
    """Sorted distinct non-null values of ``col`` (small by contract)."""
    rows = (df.select(col).where(F.col(col).isNotNull()).distinct()
            .orderBy(col).collect())
    if max_levels is not None and len(rows) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} distinct values; "
                         "use one_hot_vector for high-cardinality columns")
    return [r[0] for r in rows]


def vocabularies(df: DataFrame, cols: list[str], max_levels: int | None = None) -> dict[str, list]:
    """Sorted vocabularies of several columns in one pass over ``df``.

    String columns are stacked into (column, value) pairs and de-duplicated
    by one distributed ``distinct`` (partial-aggregated, so a value owning a
    third of the rows costs nothing extra). Other column types take one job
    each.
    """
    types = dict(df.dtypes)
    strings = [c for c in cols if types[c] == "string"]
    out: dict[str, list] = {}
    if len(strings) > 1:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(f"`{c}`").alias("val"))
                                    for c in strings])).alias("p")
        stacked = (df.select(pairs).select("p.col", "p.val").where(F.col("val").isNotNull())
                   .distinct())
        rows = stacked.collect()
        for c in strings:
            vals = sorted(r["val"] for r in rows if r["col"] == c)
            if max_levels is not None and len(vals) > max_levels:
                raise ValueError(f"{c} has more than {max_levels} distinct values; "
                                 "use one_hot_vector for high-cardinality columns")
            out[c] = vals
    for c in cols:
        if c not in out:
            out[c] = vocabulary(df, c, max_levels)
    return out


def dummy_name(source: str, value) -> str:
    """``<source>_<value>`` with every run of other characters than letters
    (of any script) and digits replaced by ``_``; the reference named dummies
    by the raw value, so the same value in two columns collided and names such
    as ``Entire home/apt`` needed quoting everywhere."""
    return re.sub(r"[\W_]+", "_", f"{source}_{value}").strip("_")


def dummy_names(source: str, values: list) -> list[str]:
    """Names of the dummies of one column. Values whose names would be equal
    (they differ in punctuation or case only) get a short hash of the value."""
    plain = [dummy_name(source, v) for v in values]
    count = Counter(n.lower() for n in plain)
    return [n if count[n.lower()] == 1 and n.lower() != source.lower() else
            f"{n}_{hashlib.md5(str(v).encode()).hexdigest()[:6]}" for n, v in zip(plain, values)]


def one_hot(df: DataFrame, cols: list[str] | str, vocab: dict[str, list] | None = None,
            drop_source: bool = True, max_levels: int | None = None) -> DataFrame:
    """One int 0/1 column per level, no level dropped. A value absent
    from a supplied vocabulary (e.g. seen only in test rows) gets all 0."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    vocab = dict(vocab or {})
    missing = [c for c in cols if c not in vocab]
    if missing:
        vocab.update(vocabularies(df, missing, max_levels))
    new_cols = []
    seen = set(c.lower() for c in df.columns)
    for c in cols:
        for name, v in zip(dummy_names(c, vocab[c]), vocab[c]):
            if name.lower() in seen:
                raise ValueError(f"dummy column {name!r} collides with an existing column")
            seen.add(name.lower())
            new_cols.append(F.when(F.col(c) == F.lit(v), F.lit(1)).otherwise(F.lit(0)).alias(name))
    keep = [F.col(f"`{c}`") for c in df.columns if not (drop_source and c in cols)]
    return df.select(*keep, *new_cols)


def one_hot_vector(cols: list[str], handle_invalid: str = "keep"):
    """Feature-path encoder stages: StringIndexer + OneHotEncoder with no
    dropped level; output columns ``<col>_vec``."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid=handle_invalid,
                         stringOrderType="alphabetAsc") for c in cols]
    enc = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols],
                        outputCols=[f"{c}_vec" for c in cols], dropLast=False,
                        handleInvalid="keep" if handle_invalid == "keep" else "error")
    return idx + [enc]


def assembler(inputs: list[str], output: str = "features",
              handle_invalid: str = "skip") -> VectorAssembler:
    """E2 stage: dense/sparse vector from named columns (by name, never by
    position, so the off-by-one that dropped the last feature cannot
    happen). ``skip`` drops rows with nulls, ``error`` fails, ``keep`` NaN."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output,
                           handleInvalid=handle_invalid)


MISSING = ("impute", "skip", "error")


def feature_stages(df: DataFrame, inputs: list[str], output: str = "features",
                   missing: str = "impute") -> list:
    """Stages that turn ``inputs`` into one vector, with a stated choice for
    missing values (null, NaN): ``impute`` puts the median of the rows the
    pipeline is fitted on (training rows) in their place, so that every row is
    fitted, clustered and scored; ``skip`` leaves such rows out (count them
    with ``missing_counts``); ``error`` fails. Columns that cannot be null and
    vector columns are taken as they are."""
    if missing not in MISSING:
        raise ValueError(f"missing must be one of {MISSING}, not {missing!r}")
    if missing != "impute":
        return [assembler(inputs, output, missing)]
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double")
    gaps = [f.name for f in df.schema.fields if f.name in inputs and f.nullable
            and (f.dataType.simpleString() in numbers or f.dataType.simpleString().startswith("decimal"))]
    filled = {c: f"_filled_{c}" for c in gaps}
    stages = [Imputer(strategy="median", inputCols=gaps, outputCols=[filled[c] for c in gaps])] if gaps else []
    return [*stages, assembler([filled.get(c, c) for c in inputs], output, "error")]


def drop_feature_columns(df: DataFrame, *more: str) -> DataFrame:
    """Without the columns that the feature stages added."""
    return df.drop(*[c for c in df.columns if c.startswith("_filled_") or c in more])


def missing_counts(df: DataFrame, inputs: list[str]) -> DataFrame:
    """One row: rows, rows with any missing input, and missing values by input."""
    gap = {c: (F.col(f"`{c}`").isNull() | F.isnan(c) if dict(df.dtypes)[c] in ("double", "float")
               else F.col(f"`{c}`").isNull()) for c in inputs}
    some = reduce(lambda a, b: a | b, gap.values(), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(some).alias("n_incomplete"),
                  *[F.count_if(g).alias(c) for c, g in gap.items()])


def assemble(df: DataFrame, inputs: list[str], label: str | None = None,
             output: str = "features", handle_invalid: str = "skip",
             keep: list[str] | None = None) -> DataFrame:
    """``(keep..., features, label)``."""
    out = assembler(inputs, output, handle_invalid).transform(df)
    cols = list(keep or []) + [output] + ([F.col(label).cast("double").alias("label")] if label else [])
    return out.select(*cols)


def categorical_indexer(max_categories: int = 5, input_col: str = "features",
                        output_col: str = "indexedFeatures") -> VectorIndexer:
    """E3 stage: features with at most ``max_categories`` distinct values are
    treated as categorical. ``handleInvalid='keep'`` so a category first
    seen at scoring time does not fail the job."""
    return VectorIndexer(inputCol=input_col, outputCol=output_col,
                         maxCategories=max_categories, handleInvalid="keep")


def index_categorical(df: DataFrame, inputs: list[str], max_categories: int = 5) -> DataFrame:
    """E3 as a report: fit the indexer on ``inputs`` and return one row per
    feature with its number of categories (null when continuous)."""
    vec = assembler(inputs, "features", "skip").transform(df)
    model = categorical_indexer(max_categories).fit(vec)
    cmap = model.categoryMaps
    rows = [(name, i, len(cmap[i]) if i in cmap else None, i in cmap)
            for i, name in enumerate(inputs)]
    return df.sparkSession.createDataFrame(
        rows, "feature string, position int, n_categories int, is_categorical boolean")
