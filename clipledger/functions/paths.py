"""Names derived from paths, voices and sequence numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipledger.schema import METHOD_REVOICED, SEQUENCE_PREFIX


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basename(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def parent_name(path: Column | str) -> Column:
    """Name of the folder that holds the file."""
    return F.regexp_extract(_col(path), r"([^/]*)/[^/]*$", 1)


def suffix(name: Column | str) -> Column:
    """Last extension with its dot; a leading or trailing dot is no extension."""
    return F.regexp_extract(_col(name), r"(?s)^.+(\.[^.]+)$", 1)


def stem(name: Column | str) -> Column:
    name = _col(name)
    return F.substring(name, F.lit(1), F.length(name) - F.length(suffix(name)))


def root_of(name: Column | str) -> Column:
    """The name without its last extension, where "a." counts as having one."""
    return F.regexp_replace(_col(name), r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")


def wav_for_transcript(path: Column | str) -> Column:
    """Every ".mp3" in the name becomes ".wav"."""
    return F.replace(_col(path), F.lit(".mp3"), F.lit(".wav"))


def wav_for_member(member: Column | str) -> Column:
    """Only the last extension is exchanged for ".wav"."""
    return F.concat(root_of(basename(member)), F.lit(".wav"))


def wav_for_engine_clip(path: Column | str) -> Column:
    return F.concat(F.replace(stem(basename(path)), F.lit("_raw"), F.lit("")), F.lit(".wav"))


def speech_name(wav: Column | str, voice_label: Column) -> Column:
    return F.replace(_col(wav), F.lit(".wav"), F.concat(F.lit("_"), voice_label, F.lit(".wav")))


def revoiced_name(wav: Column | str, voice: Column | str) -> Column:
    return F.concat(F.lit("sts_"), _col(voice), F.lit("_"), stem(wav), F.lit(".wav"))


def target_path(root: str, voice: Column | str, filename: Column | str) -> Column:
    return F.concat_ws("/", F.lit(root), _col(voice), _col(filename))


def api_voice_label(voice_id: Column | str) -> Column:
    return F.concat(F.lit("elevenlabs_"), F.substring(_col(voice_id), 1, 8))


def cloned_voice_label(speaker_wav: Column | str, voice_name: Column | None = None) -> Column:
    derived = F.concat(F.lit("xtts_v2_"), F.substring(stem(basename(speaker_wav)), 1, 20))
    if voice_name is None:
        return derived
    return F.coalesce(F.nullif(voice_name, F.lit("")), derived)


def revoiced_label(voice: Column | str) -> Column:
    return F.concat(F.lit(METHOD_REVOICED + "_"), _col(voice))


def voice_slug(voice: Column | str) -> Column:
    return F.translate(_col(voice), " ", "_")


def sequence_name(index: Column | str) -> Column:
    """Six digits at least; larger numbers keep all of theirs."""
    return F.format_string(SEQUENCE_PREFIX + "%06d.wav", _col(index).cast("bigint"))


def sequence_index(filename: Column | str) -> Column:
    """Inverse of `sequence_name`; NULL for any other name."""
    digits = F.regexp_extract(_col(filename), rf"^{SEQUENCE_PREFIX}(\d+)\.wav$", 1)
    return digits.try_cast("bigint")


def is_corpus_member(member: Column | str, is_file: Column | str = "is_file") -> Column:
    """A file ending in .mp3 below a clips folder, with either path separator."""
    member = _col(member)
    return (
        _col(is_file)
        & member.endswith(".mp3")
        & (member.contains("/clips/") | member.contains("\\clips\\"))
    )
