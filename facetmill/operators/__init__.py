"""Frame-to-frame steps."""

from .faces import explode_faces, flat_cards, join_faces, multi_faces, select_faces, single_faces, union_faces
from .features import (
    build_vocabulary,
    encode_tokens,
    encoded_training_set,
    hash_split,
    is_test_row,
    tokens,
    training_set,
    with_row_text,
)
from .gold import (
    distinct_faces,
    fill_null_token,
    first_per_group,
    gold_transform,
    observe_faces,
    observed_faces,
    pad_second_face,
    pivot_faces,
)
from .joins import full_outer_using, select_or_null
from .model import (
    confusion_counts,
    each_text,
    evaluate,
    evaluate_scored,
    fit_classifier,
    log_loss,
    score_with,
    score_with_model,
    select_results,
    unpack_results,
)
from .model_checks import gradient_share, recomputed_scores, recomputed_token_scores
from .silver import silver_transform
from .token_model import TokenModel, fit_token_model, score_with_token_model, with_token_probability

__all__ = [
    "TokenModel",
    "build_vocabulary",
    "confusion_counts",
    "distinct_faces",
    "each_text",
    "encode_tokens",
    "encoded_training_set",
    "evaluate",
    "evaluate_scored",
    "explode_faces",
    "fill_null_token",
    "first_per_group",
    "fit_classifier",
    "fit_token_model",
    "flat_cards",
    "full_outer_using",
    "gold_transform",
    "gradient_share",
    "hash_split",
    "is_test_row",
    "join_faces",
    "log_loss",
    "multi_faces",
    "observe_faces",
    "observed_faces",
    "pad_second_face",
    "pivot_faces",
    "recomputed_scores",
    "recomputed_token_scores",
    "score_with",
    "score_with_model",
    "score_with_token_model",
    "select_faces",
    "select_or_null",
    "select_results",
    "silver_transform",
    "single_faces",
    "tokens",
    "training_set",
    "union_faces",
    "unpack_results",
    "with_row_text",
    "with_token_probability",
]
