"""Plan the move of all files into the flat real/ and fake/ folders."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.operators.locate import locate_files
from clipledger.operators.names import decollide_names, flat_path
from clipledger.operators.ordering import take_first
from clipledger.operators.outcomes import successes
from clipledger.schema import MANIFEST_FIELDS
from clipledger.session import stored


class FlattenPlan(NamedTuple):
    moves: DataFrame     # entry_seq, label, path, filepath, filename, name, renamed
    missing: DataFrame   # entries without a file
    manifest: DataFrame  # the ledger after the move

    def first_missing(self, n: int = 5) -> list[str]:
        """Names of the first entries without a file, to be shown beside the counts."""
        return [r["filename"] for r in take_first(self.missing, n, "entry_seq").collect()]


def flatten_plan(manifest: DataFrame, files: DataFrame) -> FlattenPlan:
    """`moves` tells whoever moves files what goes where; nothing is moved here.

    `manifest` is the ledger if every move succeeds; see `moved_manifest`.
    """
    located = stored(locate_files(
        manifest.select("entry_seq", "filename", "label", "voice_model"), files), "located")
    found = located.where(F.col("path").isNotNull())
    missing = located.where(F.col("path").isNull()).drop("path")
    moves = decollide_names(found).withColumn("filepath", flat_path())
    return FlattenPlan(moves, missing, moved_manifest(manifest, moves))


def moved_manifest(manifest: DataFrame, moves: DataFrame, outcomes: DataFrame | None = None) -> DataFrame:
    """The ledger after the moves that succeeded.

    outcomes: entry_seq and error (NULL for a success).  Entries that were not
    located, were not tried or failed keep their name and path.
    """
    if outcomes is not None:
        moves = moves.join(successes(outcomes).select("entry_seq"), "entry_seq", "left_semi")
    placed = moves.select("entry_seq", "name", F.col("filepath").alias("placed"))
    return manifest.join(placed, "entry_seq", "left").withColumns({
        "filename": F.coalesce("name", "filename"), "filepath": F.coalesce("placed", "filepath"),
    }).select("entry_seq", *MANIFEST_FIELDS)


def moved_entries(manifest: DataFrame, moves: DataFrame, outcomes: DataFrame | None = None) -> DataFrame:
    """Only the entries that `moved_manifest` changes, for `LedgerStore.change`."""
    if outcomes is not None:
        moves = moves.join(successes(outcomes).select("entry_seq"), "entry_seq", "left_semi")
    placed = moves.select("entry_seq", "name", F.col("filepath").alias("placed"))
    moved = manifest.join(placed, "entry_seq").where(
        ~F.col("name").eqNullSafe(F.col("filename")) | ~F.col("placed").eqNullSafe(F.col("filepath")))
    return moved.withColumns({"filename": F.col("name"), "filepath": F.col("placed")}).select("entry_seq", *MANIFEST_FIELDS)
