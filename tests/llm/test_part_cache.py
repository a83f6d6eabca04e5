"""The parts a worker holds: a vocabulary of 200,000 is searched once, and what is held stays bounded."""

from ledgerloom.llm import sentencepiece_lattice as lattice


class Counting:
    """Stands for a model; notes the parts that are searched."""

    pairs = ("xx",)

    def __init__(self):
        self.searched = 0

    def first(self, part):
        self.searched += 1
        return part.encode(), 0.0, 0.0


def test_parts_of_a_large_vocabulary_are_searched_once():
    model = Counting()
    firsts = lattice.Firsts(model)
    parts = [f"{i}xx" for i in range(200_000)]
    for _ in range(2):
        assert all(firsts[p][0] == p.encode() for p in parts)
    assert model.searched == len(parts)


def test_held_parts_are_bounded(monkeypatch):
    monkeypatch.setattr(lattice, "CACHED_PARTS", 100)
    firsts = lattice.Firsts(Counting())
    for i in range(1000):
        firsts[f"{i}xx"]
        assert len(firsts) + len(firsts.older) <= 100
