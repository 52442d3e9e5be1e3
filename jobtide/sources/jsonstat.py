"""JSON-stat2 cubes to long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import as_col

CUBE_SCHEMA = (
    "id array<string>, size array<int>, value array<double>, "
    "dimension map<string, struct<category: struct<label: map<string,string>>>>"
)


def parse_cube(text: Column | str) -> Column:
    return F.from_json(as_col(text), CUBE_SCHEMA)


def _labels(cube: Column, dimension) -> Column:
    return F.map_values(F.element_at(cube["dimension"], dimension)["category"]["label"])


def _stride(cube: Column, dimension: str) -> Column:
    """Cells between two labels of the dimension: the product of the later label counts."""
    place = F.array_position(cube["id"], dimension).cast("int")
    later = F.slice(cube["id"], place + 1, F.greatest(F.size(cube["id"]) - place, F.lit(0)))
    sizes = F.transform(later, lambda d: F.size(_labels(cube, d)).cast("long"))
    return F.aggregate(sizes, F.lit(1).cast("long"), lambda a, n: a * n)


def _label_at(labels: Column, stride: Column, position: Column) -> Column:
    """Label at a row-major position, by index arithmetic."""
    index = F.pmod(F.floor(position / stride), F.size(labels)).cast("int")
    return F.when(stride > 0, F.get(labels, index))


def _explode_structs(df: DataFrame, cells: Column, keep: Sequence[str]) -> DataFrame:
    """One row per struct, carrying nothing else of the row than the kept columns."""
    found = df.select(*keep, F.explode_outer(cells).alias("_x")).where(F.col("_x").isNotNull())
    return found.select(*keep, "_x.*")


def decode_cubes(
    df: DataFrame,
    text: str,
    dimensions: Sequence[str],
    value_name: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per cell: the labels of the named dimensions and the value.

    Each cell finds its labels by its position in the dense value list, so no product of the label
    lists is built; labels are put beside the values before the list is taken apart, so a row
    holds one cell and not the cube.  Dimensions that are not named (constant ones) are dropped.
    """
    cube = F.col("_cube")
    parts = df.select(*keep, parse_cube(text).alias("_cube")).select(
        *keep,
        cube["value"].alias("_value"),
        *[_labels(cube, F.lit(d)).alias(f"_l{i}") for i, d in enumerate(dimensions)],
        *[_stride(cube, d).alias(f"_s{i}") for i, d in enumerate(dimensions)],
    )

    def cell(value: Column, position: Column) -> Column:
        names = [
            _label_at(F.col(f"_l{i}"), F.col(f"_s{i}"), position).alias(d)
            for i, d in enumerate(dimensions)
        ]
        return F.struct(*names, value.alias(value_name))

    return _explode_structs(parts, F.transform("_value", cell), keep)


def label_grid(df: DataFrame, lists: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Every combination of the label lists held by each row, in row-major order.

    The combinations of one row come from a counter split by index arithmetic.
    """
    sizes = [F.greatest(F.size(name), F.lit(0)).cast("long") for name in lists]
    total = F.lit(1).cast("long")
    for n in sizes:
        total = total * n
    strides = [F.lit(1).cast("long")]
    for n in reversed(sizes[1:]):
        strides.insert(0, strides[0] * n)

    def combination(position: Column) -> Column:
        return F.struct(
            *[
                _label_at(F.col(name), stride, position).alias(name)
                for name, stride in zip(lists, strides)
            ]
        )

    counter = F.when(total > 0, F.sequence(F.lit(0).cast("long"), total - 1))
    return _explode_structs(df.select(*keep, *lists), F.transform(counter, combination), keep)
