"""Run dimensions from file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Endings of result files, and the layouts of their paths.
UNRELAXED = "_unrelaxed.pdb"
RELAXED = "_relaxed.pdb"
#: The strict layout; {model} is a pattern for the model directory's name before its epoch.
STRICT = r"epoch_(\d+)/{model}(\d+)/repeat_(\d+)/predictions/(.+)_model_1_(unrelaxed|relaxed)\.pdb$"
#: Model directories that a strict parse accepts.
MODELS = "(?:your_model_epoch_|trained_model_epoch_)"
LOOSE = (r"epoch_(\d+)", r"repeat_(\d+)")


def strict_key(path: Column, models: str = MODELS) -> tuple[Column, dict[str, Column]]:
    """(whether the path has the strict layout, its epoch, repeat, chain and state).  The two epochs in a path may differ; the first counts."""
    pattern = STRICT.replace("{model}", models)
    part = lambda i: F.regexp_extract(path, pattern, i)
    number = lambda i: F.expr("try_cast(null as int)") if i is None else part(i).try_cast("int")
    return path.rlike(pattern), {"epoch": number(1), "repeat": number(3), "chain": part(4), "state": part(5)}


def loose_key(path: Column) -> tuple[Column, dict[str, Column]]:
    """(whether both markers occur, the leftmost epoch and repeat)."""
    found = path.rlike(LOOSE[0]) & path.rlike(LOOSE[1])
    return found, {
        "epoch": F.regexp_extract(path, LOOSE[0], 1).try_cast("int"),
        "repeat": F.regexp_extract(path, LOOSE[1], 1).try_cast("int"),
    }


def chain_from_name(name: Column) -> Column:
    """The file name without its ending: that of model 1, else the plain one."""
    return F.regexp_replace(name, r"(?:_model_1)?_unrelaxed\.pdb$", "")


def relaxed_sibling(path: Column) -> Column:
    """Where the relaxed counterpart of an unrelaxed file lies."""
    return F.replace(path, F.lit(UNRELAXED), F.lit(RELAXED))
