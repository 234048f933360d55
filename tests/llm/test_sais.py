import numpy as np
from hypothesis import given, settings, strategies as st

from mixtape.llm import sais


def brute(text):
    return sorted(range(len(text)), key=lambda i: text[i:])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=300), st.integers(1, 4))
def test_suffix_array_and_prefixes(text, times):
    text = text * times
    order = sais.suffix_array(np.array(text))
    expected = brute(text)
    assert order.tolist() == expected
    shared = sais.common_prefixes(np.array(text, np.uint8), order, 20)
    for a, b in zip(expected[1:], expected):
        n = 0
        while n < 20 and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        assert shared[a] == n


def test_runs_and_large_symbols():
    for text in ([0] * 500, list(range(300)) * 2, [7, 0] * 200, np.random.default_rng(0).integers(0, 1 << 20, 400).tolist()):
        assert sais.suffix_array(np.array(text)).tolist() == brute(text)


def test_induced_sorting_down_to_a_few_symbols(monkeypatch):
    """Every level by induced sorting, none by doubling."""
    monkeypatch.setattr(sais, "SHORT", 3)
    rng = np.random.default_rng(12)
    seen = []
    plain = sais._induce
    monkeypatch.setattr(sais, "_induce", lambda *a, **k: seen.append(1) or plain(*a, **k))
    for n in [*range(1, 40), 100, 500, 2000]:
        for letters in (1, 2, 4, 200):
            x = rng.integers(0, letters, n)
            if rng.random() < 0.3:
                x = np.tile(x, 2)
            assert sais.suffix_array(x).tolist() == brute(x.tolist())
    assert len(seen) > 200
