"""A chain of JVM and Python stages, saved and loaded."""

import pytest
from pyspark.ml import Transformer
from pyspark.ml.classification import LogisticRegression

from topicmill import learning
from topicmill.learning.selector import SelectedFeatures
from topicmill.operators import features as feats
from topicmill.session import stage

FLOORS = {b: 1 for b in feats.BLOCKS}


@pytest.fixture
def fitted(make_posts):
    posts = make_posts([(i, i, f"tag{i % 4}", f"word{i % 6} word{i % 4} text") for i in range(80)])
    model = feats.feature_model(posts, FLOORS)
    rows = stage(model.transform(posts).selectExpr("tweet_id", "features", "cast(tweet_id % 4 = 0 as double) as label"), "vectors")
    slicer = learning.ChiSquareTopFeatures(numTopFeatures=5).fit(rows)
    classifier = LogisticRegression(featuresCol="selected").fit(slicer.transform(rows))
    return posts, model, slicer, classifier


def test_scores_survive_saving(spark, fitted, tmp_path):
    posts, *models = fitted
    whole = learning.save_chain(str(tmp_path / "m"), *models)
    again = learning.load_chain(str(tmp_path / "m"))
    assert [type(s) for s in again.stages] == [type(s) for s in whole.stages]
    assert any(isinstance(s, SelectedFeatures) for s in again.stages)
    scores = [learning.score_rows(m.transform(posts), "tweet_id").orderBy("tweet_id").collect() for m in (whole, again)]
    assert scores[0] == scores[1] and len(scores[0]) == 80
    with pytest.raises(Exception, match="(?i)exist"):
        learning.save_chain(str(tmp_path / "m"), *models)
    learning.save_chain(str(tmp_path / "m"), *models, overwrite=True)


def test_chains_are_flat(fitted):
    _, model, slicer, classifier = fitted
    assert learning.chain(learning.chain(model, slicer), classifier).stages == [*model.stages, slicer, classifier]


def test_unsaveable_stage_is_an_error_at_once(fitted, tmp_path):
    class Loose(Transformer):
        def _transform(self, dataset):
            return dataset

    with pytest.raises(TypeError, match="Loose"):
        learning.save_chain(str(tmp_path / "m"), fitted[1], Loose())
    assert not (tmp_path / "m").exists()
