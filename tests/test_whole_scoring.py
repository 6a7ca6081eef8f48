"""Scoring does not change its path with the input's size, and reads the model that it is given."""

from citeflow.operators.compiled import compiled
from citeflow.operators.models import score
from citeflow.plans.batch_job import fit_all
from citeflow.sources.models import load_model, save_model


def test_one_path_whatever_the_size(spark, sf_small):
    f = fit_all(spark, sf_small, num_trees=5)
    large = f.test.crossJoin(spark.range(100_000_000).withColumnRenamed("id", "copy")).drop("copy")
    assert score(f.forest, f.test).columns == score(f.forest, large).columns
    assert "probabilities" in score(f.forest, f.test).columns


def test_a_loaded_copy_is_read_itself(spark, sf_small, tmp_path):
    """Copies share the uid of their model; a report of the two must not compare one with itself."""
    f = fit_all(spark, sf_small, num_trees=5)
    copy = load_model(save_model(f.forest, str(tmp_path / "model")))
    assert copy.stages[-1].uid == f.forest.stages[-1].uid
    assert compiled(copy) is not compiled(f.forest)
    assert compiled(copy) is compiled(copy)
    # another model under that uid
    tree = f.tree.stages[-1]
    uid = tree.uid
    try:
        tree._resetUid(f.forest.stages[-1].uid)
        keys = ["summons_number", "prediction", "p_target"]
        rows = sorted(map(tuple, score(f.tree, f.test).select(*keys).collect()))
        assert rows == sorted(map(tuple, score(f.tree, f.test, compile_trees=False).select(*keys).collect()))
    finally:
        tree._resetUid(uid)


def test_only_the_models_that_are_read_are_fitted(spark, sf_small, monkeypatch):
    from citeflow.operators import models
    from citeflow.plans import batch_job, catalog
    fits = []
    plain = models.train_models
    monkeypatch.setattr(models, "train_models", lambda train, features, ests: fits.append(len(ests)) or plain(train, features, ests))
    monkeypatch.setattr(batch_job, "_CACHE", {})
    assert catalog.QUERIES["shapley_additive"](spark, sf_small).count() == 15 and fits == []
    f = batch_job.fitted(spark, sf_small, num_trees=2)
    assert f.forest is f.forest and fits == [1] and list(f.models) == ["forest"]
    assert f.fit("forest", "tree").tree is f.tree and fits == [1, 1]
    assert batch_job.fit_all(spark, sf_small, num_trees=1).fit("tree") and fits == [1, 1, 2]


def test_the_clean_sets_the_method_limit_where_it_is_unset():
    from citeflow.session import keep_methods_compiled

    class Conf(dict):
        def get(self, key, default):
            return dict.get(self, key, default)

        def set(self, key, value):
            self[key] = value

    class Session:
        def __init__(self, **conf):
            self.conf = Conf(conf)

    key = "spark.sql.codegen.hugeMethodLimit"
    plain, told = Session(), Session(**{key: "65535"})
    keep_methods_compiled(plain)
    keep_methods_compiled(told)
    assert plain.conf == {key: "8000"} and told.conf == {key: "65535"}
