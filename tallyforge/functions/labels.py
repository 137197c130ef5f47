"""Label text to id and back."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_label(text: Column, labels: Mapping[str, int]) -> Column:
    """Id of a tidy label, NULL for one that is not in the mapping."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v).cast("bigint")) for k, v in labels.items())
    return F.try_element_at(F.create_map(*pairs), text)


def invert_labels(labels: Mapping[str, object] | None, default: Mapping[str, int]) -> dict[int, str]:
    """Id to label; entries whose id is no integer are skipped, an empty result takes the default."""
    inverse: dict[int, str] = {}
    for name, code in (labels or default).items():
        try:
            inverse[int(code)] = str(name)
        except (TypeError, ValueError):
            pass
    return inverse or {code: name for name, code in default.items()}


def decode_label(code: Column, names: Mapping[int, str]) -> Column:
    """Label of an id; an unknown id keeps its own text."""
    pairs = chain.from_iterable((F.lit(k).cast("bigint"), F.lit(v)) for k, v in names.items())
    known = F.try_element_at(F.create_map(*pairs), code.cast("bigint"))
    return F.coalesce(known, code.cast("string"))
