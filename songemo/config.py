"""Settings shared by every job: thresholds, fixed vocabularies, limits.

Everything lives in one frozen dataclass so a job receives its settings
explicitly instead of reading module globals.  The values under the
"fixed values" comments must stay equal to the behaviour this engine
reproduces; changing them changes results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: mood tags in canonical order -----------------------------
TAG_ORDER: tuple[str, ...] = (
    "High Energy",
    "Low Energy",
    "Positive",
    "Negative",
    "Calm Focus",
    "Dramatic",
    "Neutral",
)

# --- fixed values: keyword rules for the rule-based intent ------------------
# (pattern, tags) in priority order; the first matching pattern wins.  The
# word boundary applies to the first alternative only, on purpose.
INTENT_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    (r"\bcalm\b|studying|focus", ("Calm Focus",)),
    (r"\benergetic\b|high energy|upbeat", ("High Energy", "Positive")),
    (r"\bdramatic\b|tense|dark", ("Dramatic",)),
    (r"\bpositive\b|happy|uplifting", ("Positive",)),
    (r"\bnegative\b|sad|melancholic", ("Negative",)),
    (r"\blow energy\b|chill|subdued", ("Low Energy",)),
    (r"\bneutral\b|middle", ("Neutral",)),
)
INTENT_DEFAULT_TAGS: tuple[str, ...] = ("Neutral",)
INTENT_DEFAULT_EXPLANATION = "Songs from the middle of the emotion space (no key match)."
INTENT_RULE_EXPLANATION = "Songs matching: {tags} (rule-based)."
REPLY_DEFAULT_EXPLANATION = "Songs matching your request."

# --- fixed values: key-finding profiles (pitch classes C, C#, D, ..., B) -----
MAJOR_PROFILE: tuple[float, ...] = (
    6.35, 2.23, 3.48, 2.33, 4.38, 4.09, 2.52, 5.19, 2.39, 3.66, 2.29, 2.88,
)
MINOR_PROFILE: tuple[float, ...] = (
    6.33, 2.68, 3.52, 5.38, 2.60, 3.53, 2.54, 4.75, 3.98, 2.69, 3.34, 3.17,
)
PITCH_NAMES: tuple[str, ...] = (
    "C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B",
)
NORM_EPS = 1e-12

# --- fixed values: chroma methods in fallback order --------------------------
CHROMA_METHODS: tuple[str, ...] = ("stft", "cqt", "cens")

# --- fixed values: tempo bucket labels (note the padding and the en dash) ----
TEMPO_BUCKETS: tuple[tuple[float, str], ...] = (
    (80.0, "Slow  (<80 BPM)"),
    (120.0, "Mid   (80–120 BPM)"),
    (160.0, "Fast  (120–160 BPM)"),
)
TEMPO_BUCKET_TOP = "Very Fast  (160+ BPM)"
UNKNOWN_LABEL = "Unknown"

# --- fixed values: quadrant labels (valence on x, arousal on y) --------------
QUADRANT_HIGH_AROUSAL_LOW_VALENCE = "Tense / Angry"
QUADRANT_HIGH_AROUSAL_HIGH_VALENCE = "Happy / Euphoric"
QUADRANT_LOW_AROUSAL_LOW_VALENCE = "Sad / Somber"
QUADRANT_LOW_AROUSAL_HIGH_VALENCE = "Calm / Peaceful"

# --- fixed values: annotation column aliases, in preference order ------------
ID_ALIASES: tuple[str, ...] = ("song_id", "song", "id", "songId")
AROUSAL_ALIASES: tuple[str, ...] = ("arousal", "AM", "mean_arousal", "arousal_mean")
VALENCE_ALIASES: tuple[str, ...] = ("valence", "VM", "mean_valence", "valence_mean")

# --- fixed values: frame-measure column names of the acoustic feature files ----
FRAME_MEASURES: dict[str, str] = {
    "spectral_centroid": "pcm_fftMag_spectralCentroid_sma_amean",
    "energy": "pcm_RMSenergy_sma_amean",
    "mfcc_coef1": "pcm_fftMag_mfcc_sma[1]_amean",
    "spectral_rolloff50": "pcm_fftMag_spectralRollOff50.0_sma_amean",
    "zcr": "pcm_zcr_sma_amean",
    "spectral_flux": "pcm_fftMag_spectralFlux_sma_amean",
    "spectral_variance": "pcm_fftMag_spectralVariance_sma_amean",
    "spectral_entropy": "pcm_fftMag_spectralEntropy_sma_amean",
    "spectral_harmonicity": "pcm_fftMag_spectralHarmonicity_sma_amean",
}
BAND_PREFIX = "audSpec_Rfilt_sma["
BAND_SUFFIX = "_amean"
BAND_MAX_INDEX = 25

# --- fixed values: table layouts ---------------------------------------------
RICH_FEATURES: tuple[str, ...] = (
    "spectral_centroid",
    "energy",
    "mfcc_coef1",
    "auditory_band_variance",
    "spectral_rolloff50",
    "zcr",
    "spectral_flux",
    "spectral_variance",
    "spectral_entropy",
    "spectral_harmonicity",
)
MINIMAL_FEATURES: tuple[str, ...] = (
    "tempo",
    "spectral_centroid",
    "energy",
    "mfcc_coef1",
    "auditory_band_variance",
)
KEY_DERIVED: tuple[str, ...] = ("key_note", "key_mode", "key_signature", "is_major")
SONG_FEATURE_COLUMNS: tuple[str, ...] = (
    ("song_id",) + RICH_FEATURES + ("tempo_bpm", "genre", "key") + KEY_DERIVED
)
MODEL_FEATURES: tuple[str, ...] = RICH_FEATURES + ("tempo_bpm",)
TARGETS: tuple[str, ...] = ("arousal", "valence")
MAP_METADATA: tuple[str, ...] = (
    "key", "tempo_bpm", "genre", "key_note", "key_mode", "key_signature", "is_major",
)
TABLE_VIEW_METADATA: tuple[str, ...] = (
    "key", "key_note", "key_mode", "key_signature", "is_major", "tempo_bpm", "genre",
    "tempo_bucket",
)
COLOR_BY_OPTIONS: tuple[str, ...] = (
    "key", "tempo_bucket", "key_note", "key_mode", "key_signature",
)
RUN_ID_PATTERN = r"^\d{8}_\d{6}$"


@dataclass(frozen=True)
class Thresholds:
    """Mood-tag thresholds on the 1..9 arousal / valence scale."""

    arousal_high: float = 6.0
    arousal_low: float = 4.0
    valence_positive: float = 6.0
    valence_negative: float = 4.0
    valence_calm_focus_min: float = 5.0


@dataclass(frozen=True)
class QualityLimits:
    """Limits used by the data-quality report."""

    tempo_min: float = 20.0
    tempo_max: float = 300.0
    min_tempo_coverage_pct: float = 90.0
    min_key_coverage_pct: float = 90.0


@dataclass(frozen=True)
class Settings:
    thresholds: Thresholds = field(default_factory=Thresholds)
    quality: QualityLimits = field(default_factory=QualityLimits)
    top_k: int = 20
    test_fraction_buckets: int = 5  # hash bucket 0 of 5 is the holdout (~20 %)
    cv_folds: int = 5
    seed: int = 42
    frame_rate_hz: float = 22050.0 / 2048.0  # chroma frames per second
    middle_min_seconds: float = 10.0
    clip_seconds: float = 45.0


DEFAULT = Settings()
