import numpy as np

from audience_engine.llm import language


def test_a_text_of_six_languages_gets_all_six():
    draw = np.random.default_rng(3)
    model = draw.dirichlet(np.full(2000, 0.1), 8).T + 1e-7
    model /= model.sum(axis=0)
    share = np.array([0.3, 0.2, 0.15, 0.13, 0.12, 0.1, 0, 0])
    found = language.language_set(draw.multinomial(20_000, model @ share), model)
    assert {i for i, _ in found} == set(range(6))
    assert all(abs(s - share[i]) < 0.02 for i, s in found)
