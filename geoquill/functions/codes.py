"""Reclassification of codes as column expressions, and text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Building codes of each symbol class.
SYMBOL_CODES = {
    1: [970],
    2: [719],
    3: [671],
    4: [113, 123, 124, 163],
    5: [111, 112, 121, 122, 131, 133, 135, 136, 141, 142, 143, 144, 145, 146, 159, 161, 162, 171, 199, 524],
    6: [
        151, 152, 211, 212, 214, 221, 231, 232, 233, 243, 244, 311, 312, 313, 321, 322, 323, 330, 411, 412, 415, 416, 4131, 441, 521, 522, 523, 529, 532, 621, 641, 642, 643, 651, 652, 653, 661, 662,
        672, 673, 674, 675, 731, 821, 822, 319, 329, 449, 219, 659, 239, 439, 223, 611, 649, 229, 419, 429, 623, 655, 664, 679, 824,
    ],
    7: [531, 612, 613, 614, 615, 616, 619, 629, 819, 829, 669, 533, 539],
    8: [721, 722, 723, 732, 739, 729],
    9: [172, 181, 182, 183, 193, 216, 241, 245, 248, 654, 999, 249, 840],
    11: [956],
}
# Symbol width and height.
SYMBOL_SIZE = {1: (175, 175), 2: (175, 175), 3: (160, 120), 4: (100, 100), 5: (45, 45), 6: (45, 45), 7: (45, 45), 8: (45, 45), 9: (55, 65), 10: (130, 130), 11: (130, 130)}
# Rank of classes where points overlap; all other codes have the last.
OVERLAP_ORDER = [1, 3, 2, 11, 4, 5, 6, 7, 8]
# Order of road categories, most important first.
ROAD_CATEGORIES = "ERFKPSBTDAUG"


def symbol_class(code: Column) -> Column:
    """-99 for codes of no class."""
    out = F.lit(-99)
    for k, codes in SYMBOL_CODES.items():
        out = F.when(code.isin(codes), k).otherwise(out)
    return out


def symbol_hierarchy(symbol: Column) -> Column:
    return F.when(symbol.isin(1, 2, 3, 11), 1).when(symbol == 4, 2).otherwise(3)


def overlap_hierarchy(code: Column) -> Column:
    out = F.lit(10)
    for rank, k in enumerate(OVERLAP_ORDER, 1):
        out = F.when(code.isin(SYMBOL_CODES[k]), rank).otherwise(out)
    return out


def road_hierarchy(category: Column, road_class: Column, crossing: Column, ferry: Column) -> Column:
    """0 (most important) to 5."""
    k = F.when(road_class.between(0, 4), 1).when(road_class == 5, 2).when(road_class == 6, 3).when(road_class == 7, 4).otherwise(5)
    x = F.when(crossing == 1, F.when(category.isin("E", "R", "F"), -3).when(category == "K", -2).otherwise(-1)).otherwise(0)
    return F.when(ferry, 0).otherwise(F.least(F.lit(5), F.greatest(F.lit(0), k + x)))


def path_hierarchy(category: Column, ferry: Column) -> Column:
    return F.when(ferry | category.isin(*"ERFKPS"), 0).when(category.isin("T", "B"), 1).when(category.isin("D", "A"), 2).when(category == "G", 3).otherwise(4)


def reclassify(reference: Column, value, to) -> Column:
    return F.when(reference == value, to).otherwise(reference)


def reclassify_others(column: Column, allowed: list, to) -> Column:
    """Values out of the list, and nulls, become `to`."""
    return F.when(column.isin(allowed), column).otherwise(F.lit(to))


def category_rank(category: str) -> Column:
    """Place of the column's value in the order of road categories from 1; 13 for others and null."""
    return F.coalesce(F.expr(f"nullif(instr('{ROAD_CATEGORIES}', {category}), 0)"), F.lit(len(ROAD_CATEGORIES) + 1))


def local_number(text: Column) -> Column:
    """A number from text with local separators: null for none.

    With both separators the dot divides thousands; a lone comma is the decimal sign.
    """
    t = F.regexp_replace(F.trim(text), "[ \\u00a0]", "")
    t = F.when(t.contains(",") & t.contains("."), F.replace(F.replace(t, F.lit(".")), F.lit(","), F.lit("."))).otherwise(F.replace(t, F.lit(","), F.lit(".")))
    return F.regexp_replace(t, "[^0-9.\\-+]", "").try_cast("double")
