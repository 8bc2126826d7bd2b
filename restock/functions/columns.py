"""Scalar rules of the domain as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the published results.
SALES_LEVEL_LABELS = {"1": "畅", "2": "平", "3": "滞"}
MISSING_ORG = "111"
BLANKS = ("", "None")
DEFAULT_TRANSFER_LEVEL = "operating_unit"
LABEL_SOURCE = "01"
LABEL_CODE = "00014"
TRANSFER_LEVEL_PARAMETER = "gto.replenish_transfer_level"
OPEN_STATUS = "正常"
WAREHOUSE_FLAG = "2"
CHANGED_STATUSES = ("1", "2", "3")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_changed(status: Column | str) -> Column:
    return col(status).isin(*CHANGED_STATUSES)


def org_or_sentinel(org: Column | str) -> Column:
    """A missing org counts as the sentinel org in key sets."""
    return F.coalesce(col(org), F.lit(MISSING_ORG))


def sales_level_label(code: Column | str) -> Column:
    """Seller speed label of a level code, NULL for any other code."""
    labels = F.create_map(*[F.lit(x) for pair in SALES_LEVEL_LABELS.items() for x in pair])
    return F.try_element_at(labels, col(code))


def non_blank(c: Column | str) -> Column:
    """The value, or NULL where it is blank (also the text 'None' left by an older writer)."""
    return F.when(~col(c).isin(*BLANKS), col(c))


def first_non_blank(named: dict[str, Column | str]) -> tuple[Column, Column]:
    """First non-blank of several columns, and the name of the one that supplied it."""
    value = F.coalesce(*[non_blank(c) for c in named.values()])
    label = F.coalesce(*[F.when(non_blank(c).isNotNull(), F.lit(n)) for n, c in named.items()])
    return value, label


def exposed_if(flag: Column | str, wanted: str, value: Column | str) -> Column:
    return F.when(col(flag) == wanted, col(value))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Numerator over denominator to two decimals, half up; 0 where the denominator is 0, NULL where it is NULL."""
    n = F.coalesce(col(numerator), F.lit(0)).cast("decimal(20,0)")
    d = col(denominator).cast("decimal(20,0)")
    return F.when(d == 0, F.lit(0).cast("decimal(16,2)")).otherwise((n / d).cast("decimal(16,2)"))


def score(value: Column | str) -> Column:
    """A priority score as a fixed-point number with two decimals, half up."""
    return col(value).cast("decimal(16,2)")


def at_level(names: Column | str, values: Column | str, level: Column | str, sep: str = ":") -> Column:
    """Value of one level in a path, the levels being named by a parallel path.

    NULL if the level is absent or the paths differ in length.  Of levels named twice the last counts.
    """
    keys = F.split(col(names), sep)
    parts = F.split(col(values), sep)
    position = F.size(keys) - F.array_position(F.reverse(keys), col(level)) + 1
    return F.when(
        (F.size(keys) == F.size(parts)) & F.array_contains(keys, col(level)),
        F.try_element_at(parts, position.cast("int")),
    )


def path_depth(path: Column | str, sep: str = ":") -> Column:
    return F.when(col(path).isNotNull(), F.size(F.split(col(path), sep)))


def class_level(codes: Column | str, types: Column | str) -> tuple[Column, Column, Column]:
    """Depth, code of the labelled level, and class label of a product class path.

    The label lists ``type#code`` of every level but the deepest, for paths of two to four levels; any other
    depth has no label.
    """
    depth = path_depth(codes)
    level = F.when(depth.between(2, 4), depth - 1)
    code_parts = F.split(col(codes), ":")
    type_parts = F.split(col(types), ":")

    def tag(i: Column) -> Column:
        # A level the type path does not reach has an empty type.
        kind = F.coalesce(F.get(type_parts, i - 1), F.lit(""))
        return F.concat(kind, F.lit("#"), F.get(code_parts, i - 1))

    label = F.array_join(F.transform(F.sequence(F.lit(1), F.coalesce(level, F.lit(1))), tag), "&")
    known = level.isNotNull() & col(types).isNotNull()
    return depth, F.when(known, F.get(code_parts, level - 1)), F.when(known, label)


def json_setting(json: Column | str, name: str) -> Column:
    """One field of a JSON setting; the name may hold dots."""
    return F.get_json_object(col(json), f"$['{name}']")
