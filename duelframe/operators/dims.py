"""The emcee dimension and the alias map."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe.operators.columns import unused
from duelframe.sources.staging import staged

# Alias -> canonical name. No canonical name is an alias.
ALIASES: dict[str, str] = {
    "Daddie Joe D": "Daddy Joe D",
    "DaddyJoe D": "Daddy Joe D",
    "D.O.C. Pau": "Doc Pau",
    "DOC Pau": "Doc Pau",
    "Damnsa": "Damsa",
    "Pareng Elbiz": "Elbiz",
    "Flip": "Flipzydot1",
    "Frooztreitted Hoemmizyd": "Frooz",
    "GusTav": "Gustav",
    "Hallucinate": "Kris Delano",
    "Ice Rocks": "Saint Ice",
    "J Skeelz": "J-Skeelz",
    "Japormz": "Jhapormz",
    "JayTee": "Jaytee",
    "joshG": "Josh G",
    "JoshG": "Josh G",
    "Juan Lazy": "Juan Tamad",
    "Hearty Tha Bomb": "Hearty",
    "Mac-T": "Mac T",
    "Malupet": "Malupit",
    "Marshall": "Marshall Bonifacio",
    "Mel Christ": "Melchrist",
    "MelChrist": "Melchrist",
    "Nerdskillz": "Nerd Skillz",
    "One3D": "One3d",
    "Poison 13": "Poison13",
    "B.I.L.L.Y.": "Prosecutor Billy",
    "R Zone": "R-Zone",
    "RanieBoy": "Ranieboy",
    "Righteous-One": "Righteous One",
    "Righteous1": "Righteous One",
    "Single Shot": "SingleShot",
    "Spade": "Goriong Talas",
    "Stiffler": "Stiff",
    "Tim aka Cleave Heckler": "Tim",
    "W-Beat": "W Beat",
    "WBeat": "W Beat",
    "Young One": "YoungOne",
    "2Khelle": "2khelle",
    "Akt": "AKT",
    "Crhyme": "CRhyme",
    "Markong Bungo": "Poison13",
    "Freak Sanchez": "Tipsy D",
    "Ghostly": "Goriong Talas",
    "No. 144": "Emar Industriya",
    "Carlito": "Sayadd",
    "sKarm": "Skarm",
    "Cripli": "CripLi",
    "M-Zhayt": "M Zhayt",
    "Jdee": "JDee",
    "Mastafeat": "MastaFeat",
    "Cnine": "CNine",
    "Sinagtala": "GL",
    "1ce Water": "J-Blaque",
    "Deadpan": "Shehyee",
    "Mia Sonin": "Batang Rebelde",
    "GameBoy": "Gameboy",
    "Lil Strocks": "LilStrocks",
    "Lil John": "LilJohn",
    "NIkki": "Nikki",
    "Nico": "AKT",
}


def distinct_names(df: DataFrame, *cols: str) -> DataFrame:
    """(name) all values of cols that aren't null, once each."""
    return df.select(F.explode(F.array(*cols)).alias("name")).where("name is not null").distinct()


def dense_ids(names: DataFrame, col: str = "name", id_col: str = "id") -> DataFrame:
    """Distinct names numbered from 1 in code-point order.

    The names are dealt to ranges, sorted there and written once with their places; the
    ranges' sizes then give the number that each begins with. So names are computed
    once, and no task holds more than a range, however alike their beginnings are.
    """
    at, number, size, before = (unused(c, names) for c in ("at", "range", "size", "before"))
    ordered = names.select(col).repartitionByRange(col).sortWithinPartitions(col)
    # the place within a partition is the lower 33 bits of this id, the partition the others
    rows = staged(ordered.withColumn(at, F.monotonically_increasing_id()))
    rows = rows.select(col, F.shiftright(at, 33).alias(number), F.col(at).bitwiseAND(F.lit((1 << 33) - 1)).alias(at))
    sizes = rows.groupBy(number).agg(F.count("*").alias(size))
    upto = F.sum(size).over(Window.orderBy(number).rowsBetween(Window.unboundedPreceding, 0))
    offsets = sizes.select(number, (upto - F.col(size)).alias(before))  # a row for each range
    return rows.join(F.broadcast(offsets), number).select((F.col(before) + F.col(at) + 1).cast("int").alias(id_col), col)


def build_emcees(battles: DataFrame) -> DataFrame:
    """(emcee_id, emcee_name), in the order of names. Ids hold while the set of names does."""
    names = distinct_names(battles, "emcee1", "emcee2").withColumnRenamed("name", "emcee_name")
    return dense_ids(names, "emcee_name", "emcee_id").orderBy("emcee_id")
