"""P25: conformance of scoring requests that bring their own features (customers without a record).

A request is a map of feature name to text. The schema, taken from the training rows, is compiled to column
expressions: a request without any feature, or with a feature that the model does not know, is rejected with the
reason (a misspelt name must not be dropped in silence); known features are typed as in training. Text that is no
number, and a level that training did not hold, become NULL, which the data-quality level then counts."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.operators.scorecard import frequent_levels, long_categorical

NAMED_UNKNOWN = 10      # unknown names that a reason lists


@dataclass(frozen=True)
class RequestSchema:
    numeric: tuple[str, ...]
    categorical: dict[str, tuple[str, ...]]

    @classmethod
    def of_training(cls, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], id_col: str, label: str) -> RequestSchema:
        """Levels are those of at least one per cent of the rows: at most a hundred a feature reach the driver."""
        levels: dict[str, list[str]] = {c: [] for c in categorical}
        if categorical:
            for r in frequent_levels(long_categorical(train, categorical, id_col, label)).select("feature", "level").collect():
                levels[r["feature"]].append(r["level"])
        return cls(tuple(numeric), {c: tuple(sorted(x)) for c, x in levels.items()})

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *self.categorical]


def rejection(features: Column, schema: RequestSchema) -> Column:
    """Why a request cannot be scored, or NULL."""
    unknown = F.sort_array(F.array_except(F.map_keys(features), F.lit(schema.names)))

    def named(names: Column) -> Column:
        return F.when(F.size(names) > 0, F.concat(F.lit("unknown features: "), F.array_join(F.slice(names, 1, NAMED_UNKNOWN), ", "),
                                                  F.when(F.size(names) > NAMED_UNKNOWN, " ...").otherwise("")))

    return F.when(features.isNull() | (F.size(features) == 0), F.lit("empty request")).otherwise(
        F.get(F.transform(F.array(unknown), named), 0))        # the names are searched once


def given(features: Column, schema: RequestSchema) -> Column:
    """The texts of the model's features in the order of its names, NULL for those that the map lacks. One pass over both by
    hash: a look-up of every name would search the map, features x features steps a request."""
    names = list(dict.fromkeys(schema.names))
    places = F.map_from_arrays(F.lit(names), F.lit(list(range(len(names)))))
    return F.map_values(F.map_zip_with(places, features, lambda name, place, text: text))


def typed(texts: Column, schema: RequestSchema) -> list[Column]:
    """The model's columns from what is ``given``."""
    place, out = {name: i for i, name in enumerate(dict.fromkeys(schema.names))}, []
    for name in schema.numeric:
        v = F.get(texts, place[name])
        number = F.when(F.lower(F.trim(v)).isin("true", "false"), (F.lower(F.trim(v)) == "true").cast("double")).otherwise(v.try_cast("double"))
        out.append(F.when(~F.isnan(number), number).alias(name))
    for name, levels in schema.categorical.items():
        v = F.get(texts, place[name])
        out.append(F.when(v.isin(list(levels)) if levels else F.lit(False), v).alias(name))
    return out


def conform(requests: DataFrame, features: str, schema: RequestSchema) -> DataFrame:
    """``requests`` with ``reason`` and, in the map's place, the model's typed columns. Columns of the request that are named as
    a feature of the model are an error."""
    kept = [c for c in requests.columns if c != features]
    clash = sorted({"reason", *schema.names} & set(kept))
    if clash:
        raise ValueError(f"request columns named as the model's: {clash}")
    if not schema.names:
        return requests.select(*kept, rejection(F.col(features), schema).alias("reason"))
    texts = max([*requests.columns, "reason", *schema.names], key=len) + "_"        # a name that none of them has
    once = requests.select(*kept, rejection(F.col(features), schema).alias("reason"), given(F.col(features), schema).alias(texts))
    return once.select(*kept, "reason", *typed(F.col(texts), schema))
