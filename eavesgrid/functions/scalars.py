"""Small column expressions over codes, paths, labels and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"
COMMUNE_DIGITS = 5
# Fixed value: names of crops cut at a raster border, e.g. "75_1"; matched anywhere in the name.
SUFFIXED_NAME = r"\d_\d{1,2}"


def commune_code(building_group: Column) -> Column:
    return F.substring(building_group, 1, COMMUNE_DIGITS)


def fill_unknown(col: Column) -> Column:
    return F.coalesce(col, F.lit(UNKNOWN))


def path_stem(path: Column) -> Column:
    """File name without folder and last extension; a leading dot is part of the name."""
    name = F.regexp_extract(path, r"([^/]+)/*$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def keep_plain_names(name: Column) -> Column:
    """False for suffixed names and for names with a dot."""
    return ~name.rlike(SUFFIXED_NAME) & ~name.contains(".")


def argmax_class(probs: Column) -> Column:
    """Index of the largest probability, the first one on a tie."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def softmax(values: Column) -> Column:
    exps = F.transform(values, lambda v: F.exp(v))
    return F.transform(exps, lambda v: v / F.aggregate(exps, F.lit(0.0), lambda a, b: a + b))


def softmax_score(probs: Column, double_softmax: bool = False) -> Column:
    """Largest probability; ``double_softmax`` applies softmax once more to the model's output."""
    return round7(F.array_max(softmax(probs) if double_softmax else probs))


def round7(score: Column) -> Column:
    return F.round(score, 7)


def threshold_class(p: Column, threshold: float = 0.5) -> Column:
    """1 where p lies strictly above the threshold, 0 where it doesn't, NULL where p is."""
    return F.when(p > threshold, F.lit(1)).when(p.isNotNull(), F.lit(0))


def class_name(index: Column, class_names: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(n) for n in class_names]), index.cast("int"))


def class_index(name: Column, class_names: Sequence[str]) -> Column:
    """0-based position of the name; NULL for a name that is not a class."""
    position = F.array_position(F.array(*[F.lit(n) for n in class_names]), name)
    return F.when(position > 0, (position - 1).cast("int"))


def encode_label(index: Column, mode: str, class_names: Sequence[str]) -> Column:
    """``int``, ``binary`` (float, two classes only) or ``categorical`` (one-hot floats)."""
    if mode == "int":
        return index.cast("int")
    if mode == "binary":
        if len(class_names) != 2:
            raise ValueError(f"binary labels need exactly 2 classes, got {len(class_names)}")
        return index.cast("float")
    if mode == "categorical":
        slots = F.sequence(F.lit(0), F.lit(len(class_names) - 1))
        return F.when(index.isNotNull(), F.transform(slots, lambda i: (i == index).cast("float")))
    raise ValueError(f"label mode must be int, binary or categorical, got {mode!r}")


def seeded_fraction(key: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by seed and key alone, so no ordering or partitioning can change it."""
    digest = F.md5(F.concat(F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def counted_uniform(key: Column, counter: int) -> Column:
    """Random number in [0, 1) that hangs on the key and a counter alone; any SQL engine with ``md5`` gives the same."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"#{counter}"))), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
