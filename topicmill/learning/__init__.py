from topicmill.learning.evaluator import RankingEvaluator
from topicmill.learning.predictions import readable_predictions, score_rows
from topicmill.learning.saved import chain, load_chain, save_chain
from topicmill.learning.selector import ChiSquareTopFeatures
from topicmill.learning.tuner import FixedValidationTuner, best_params, default_grid, summarise

__all__ = [
    "ChiSquareTopFeatures",
    "FixedValidationTuner",
    "RankingEvaluator",
    "best_params",
    "chain",
    "default_grid",
    "load_chain",
    "readable_predictions",
    "save_chain",
    "score_rows",
    "summarise",
]
