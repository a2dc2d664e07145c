"""Path and run-name expressions (X1-X5). All are JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def basename(path) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def parent_name(path) -> Column:
    """``path.split('/')[-2]``."""
    return F.element_at(F.split(_c(path), "/"), -2)


def variable_name(path, tile, res) -> Column:
    """Basename, drop '.tif', drop '_{res}', drop '{tile}_', lowercase.

    ``replace`` removes every occurrence, as the reference's ``str.replace`` does.
    """
    name = F.replace(basename(path), F.lit(".tif"), F.lit(""))
    name = F.replace(name, F.concat(F.lit("_"), _c(res).cast("string")), F.lit(""))
    name = F.replace(name, F.concat(_c(tile), F.lit("_")), F.lit(""))
    return F.lower(name)


def tile_parquet_path(root: str, res, tile, suffix: str = "_byldem.parquet") -> Column:
    """``{root}{res}/{tile}/{tile}{suffix}``."""
    return F.concat(F.lit(root), _c(res).cast("string"), F.lit("/"), _c(tile), F.lit("/"), _c(tile),
                    F.lit(suffix))


def output_path(outdir: str, path) -> Column:
    """``{outdir}/{parent}/{name with .tif -> _ML.tif}``."""
    return F.concat(F.lit(outdir.rstrip("/") + "/"), parent_name(path), F.lit("/"),
                    F.replace(basename(path), F.lit(".tif"), F.lit("_ML.tif")))


def multiple_tag(m) -> Column:
    """``eq{str(m) with . -> p}xtile``; a missing multiple prints as 'None'.

    The reference's multiplier lists hold whole multiples as ints (``str(1)`` is
    '1'), fractions as floats ('0.5'); whole values print without decimals here.
    """
    d = _c(m).cast("double")
    text = F.when(d == F.floor(d), F.floor(d).cast("long").cast("string")).otherwise(d.cast("string"))
    s = F.coalesce(F.replace(text, F.lit("."), F.lit("p")), F.lit("None"))
    return F.concat(F.lit("eq"), s, F.lit("xtile"))


def run_id(rounds, n, m) -> Column:
    """``iter{rounds}_n{n}_{multiple tag}``."""
    return F.concat(F.lit("iter"), _c(rounds).cast("string"), F.lit("_n"), _c(n).cast("string"),
                    F.lit("_"), multiple_tag(m))


RUN_ID_PATTERN = r"^iter(\d+)_n(\d+)_eq(.+)xtile$"


def parse_run_id(rid) -> tuple[Column, Column, Column]:
    """(rounds, n, m) back from a run id; m is null for 'None'."""
    rid = _c(rid)
    rounds = F.regexp_extract(rid, RUN_ID_PATTERN, 1).cast("long")
    n = F.regexp_extract(rid, RUN_ID_PATTERN, 2).cast("long")
    tag = F.regexp_extract(rid, RUN_ID_PATTERN, 3)
    m = F.when(tag != F.lit("None"), F.replace(tag, F.lit("p"), F.lit(".")).cast("double"))
    return rounds, n, m
