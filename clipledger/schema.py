"""Table layouts and the fixed values of the ledger format."""

from __future__ import annotations

from pyspark.sql import types as T

# The manifest columns in file order.
MANIFEST_FIELDS = [
    "filename", "filepath", "label", "method", "voice_model", "source_file",
    "f0_method", "index_rate", "protect", "volume_envelope",
    "hop_length", "pitch", "generated_at",
]
REQUIRED_FIELDS = ["filename", "label", "method"]
DOUBLE_FIELDS = ["index_rate", "protect", "volume_envelope"]
LONG_FIELDS = ["hop_length", "pitch"]
TEXT_FIELDS = [c for c in MANIFEST_FIELDS if c not in DOUBLE_FIELDS + LONG_FIELDS]

# Labels, methods and defaults that stored corpora already use.
REAL, FAKE = "real", "fake"
METHOD_SAMPLES = "tagarela"
METHOD_LEGACY_REAL = "common_voice"
METHOD_SPEECH = "tts"
METHOD_REVOICED = "elevenlabs_sts"
METHOD_MODEL = "rvc"
UNKNOWN_TIME = "unknown"
IMPORT_TIME = "2026-03-10T00:00:00Z"
ACCENT = "pt-br"
ENGINES = ["edge", "google", "gtts", "polly"]
ENGINE_TREE = "golden_audio"
SEQUENCE_PREFIX = "tagarela_"
DEFAULT_CLIP_SECONDS = 10.7
BUDGET_FLOOR_MS = 60_000
TEST_LIMIT = 5
CHAR_QUOTA = 10_000
MAX_ATTEMPTS = 3
BACKOFF_SECONDS = 5
CLIP_WINDOW_MS = 60_000
MODEL_PARAMS = {
    "f0_method": "rmvpe",
    "index_rate": 0.75,
    "protect": 0.33,
    "volume_envelope": 0.25,
    "hop_length": 128,
    "pitch": 0,
}


def _field_type(name: str) -> T.DataType:
    if name in DOUBLE_FIELDS:
        return T.DoubleType()
    if name in LONG_FIELDS:
        return T.LongType()
    return T.StringType()


MANIFEST = T.StructType([T.StructField(c, _field_type(c)) for c in MANIFEST_FIELDS])
# entry_seq keeps the list position of an entry; rows of a table have none.
LEDGER = T.StructType([T.StructField("entry_seq", T.LongType()), *MANIFEST.fields])

LISTING = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
])
VOICES = T.StructType([
    T.StructField("ord", T.LongType()),
    T.StructField("voice", T.StringType()),
    T.StructField("voice_id", T.StringType()),
])
SAMPLES = T.StructType([
    T.StructField("audio", T.StructType([
        T.StructField("bytes", T.BinaryType()),
        T.StructField("path", T.StringType()),
    ])),
    T.StructField("accent", T.StringType()),
])
