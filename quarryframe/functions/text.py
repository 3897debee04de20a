"""String functions of the pipeline: verdict parsing, key parsing, shared affixes, flattening."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_yes_no(raw: Column) -> Column:
    """yes or no of an answer: by its beginning, else by the only word there, else by the one that comes first, else no."""
    t = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    yes, no = F.instr(t, "yes"), F.instr(t, "no")
    return (
        F.when(t.startswith("yes"), "yes").when(t.startswith("no"), "no")
        .when((yes > 0) & (no == 0), "yes").when((no > 0) & (yes == 0), "no")
        .when((yes > 0) & (yes < no), "yes").otherwise("no")
    )


def parse_visibility(raw: Column) -> Column:
    """yes, partial or no: `partial` anywhere, then `yes`, then `no` anywhere or a beginning n, y, p, in this order; else no."""
    t = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    return (
        F.when(t.contains("partial"), "partial").when(t.contains("yes"), "yes")
        .when(t.contains("no") | t.startswith("n"), "no").when(t.startswith("y"), "yes").when(t.startswith("p"), "partial").otherwise("no")
    )


def verdict_passes(cls: Column, raw: Column, by_class: bool = False) -> Column:
    """Object gate. By default as files are read downstream: `yes` anywhere in class or raw text; by_class: the class only."""
    return F.lower(cls) == "yes" if by_class else F.lower(F.concat_ws("\n", cls, raw)).contains("yes")


def parent_name(path: Column) -> Column:
    """Name of the directory that holds a file."""
    return F.element_at(F.split(path, "/"), -2)


def object_id(name: Column) -> Column:
    return F.split(name, r"\+", 2)[0]


def object_label(name: Column) -> Column:
    return F.get(F.split(name, r"\+", 2), F.lit(1))


def object_order(name: Column) -> Column:
    """Numeric sort key after `object_`; others come last."""
    return F.coalesce(F.regexp_extract(name, r"^object_(\d+)", 1).try_cast("long"), F.lit(1_000_000_000).cast("long"))


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def safe_double(text: Column, default: float | None = None) -> Column:
    """Lenient cast: text that is no number becomes NaN (or the default)."""
    return F.coalesce(text.try_cast("double"), F.lit(float("nan") if default is None else default))


def replace_all(text: Column, pairs: dict[str, str]) -> Column:
    """Replacements one after another."""
    for old, new in pairs.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def common_prefix_length(texts: Column) -> Column:
    """Length of the prefix that all strings of an array share."""
    low, high = F.array_min(texts), F.array_max(texts)
    n = F.least(F.length(low), F.length(high))
    return F.coalesce(F.array_max(F.filter(F.transform(F.sequence(F.lit(0), n), lambda i: F.when(F.substring(low, F.lit(1), i) == F.substring(high, F.lit(1), i), i).otherwise(0)), lambda x: x >= 0)), F.lit(0))


def class_subset(value: Column, classes: list[str], chosen: list[str]) -> Column:
    """Index in `classes` -> index in `chosen`; classes that are not chosen become -1. Every chosen class must be there."""
    unknown = [c for c in chosen if c not in classes]
    if unknown:
        raise ValueError(f"no such classes: {', '.join(unknown)}")
    return F.coalesce(F.create_map(*[F.lit(x) for i, c in enumerate(chosen) for x in (classes.index(c), i)])[value.cast("int")], F.lit(-1))


def cascading_remap(value: Column, pairs: dict[int, int]) -> Column:
    """In-place label remap in the order of `pairs`: a value that was mapped may be mapped again."""
    for old, new in pairs.items():
        value = F.when(value == old, new).otherwise(value)
    return value


def reduce_zero_label(value: Column) -> Column:
    """0 becomes 255 (ignored), other labels go down by one, 255 stays."""
    return F.when((value == 0) | (value == 255), 255).otherwise(value - 1)


#: Which of the labels 0 to 8 (1 and 2: hands) each mode keeps, and as what.
LABEL_MODES = {
    "allhands": {1: 1, 2: 1},
    "twohands": {1: 1, 2: 2},
    "handobj1": {1: 1, 2: 2, 3: 3, 4: 4, 5: 5},
    "obj1": {3: 1, 4: 2, 5: 3},
    "obj2": {3: 1, 4: 2, 5: 3, 6: 4, 7: 5, 8: 6},
    "foreground": {i: 1 for i in range(1, 9)},
}


def remap_label(value: Column, mode: str) -> Column:
    """Simultaneous remap; labels that the mode does not name become 0."""
    out = F.lit(0)
    for old, new in LABEL_MODES[mode].items():
        out = F.when(value == old, new).otherwise(out)
    return out


def size_bucket(area: Column) -> Column:
    return F.when(area < 32 * 32, "small").when(area < 96 * 96, "medium").otherwise("large")
