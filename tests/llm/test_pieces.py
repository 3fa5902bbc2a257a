import random

from tokenizers import Tokenizer

from endpulse.llm import pieces as lib
from endpulse.llm.queries import tokenizer_path, word_tokenizer_path

LETTERS = list("aB'sl0\t\r,.é\x1c\x85<\0=") + [
    "  ", " ", "\n", "\n\n", " \n", "\n ", " the", " don't", " ", "́", "中", "\U0001f600"]


def texts(seed, n, most=14):
    rand = random.Random(seed)
    return ["".join(rand.choice(LETTERS) for _ in range(rand.randint(0, most))) for _ in range(n)]


def test_pieces_make_up_the_text():
    for text in texts(1, 5000):
        assert "".join(map(lib.literal, lib.spaced(text))) == text


def test_ids_of_pieces_are_those_of_the_text():
    whole = Tokenizer.from_file(tokenizer_path())
    whole.encode_special_tokens = True
    ids = lambda t: whole.encode(t, add_special_tokens=False).ids
    for text in texts(2, 5000):
        assert [i for k in lib.spaced(text) for i in ids(lib.literal(k))] == ids(text)


def test_words_of_letters_have_the_ids_of_the_whole_tokenizer():
    rand = random.Random(4)
    letters = "abcXYZéÉüßñŁǅİıſªµΣ中" + "".join(map(chr, range(0xC0, 0x250, 7)))
    words = ["".join(rand.choice(letters) for _ in range(rand.randint(1, 9))) for _ in range(4000)]
    words += ["".join(rand.choice("etaoinshr") for _ in range(rand.randint(1, 12))) for _ in range(2000)]
    for path, head, lower in ((tokenizer_path(), " ", False), (word_tokenizer_path(), "", True)):
        whole = Tokenizer.from_file(path)
        model = lib.Letters(whole, head, lower)
        assert model.right
        plain = [w for w in words if model.fits(w)]
        assert 2000 < len(plain) < 6000
        for w in plain:
            assert model(w) == whole.encode(head + w, add_special_tokens=False).ids
            stem, marks = lib.marked(w + rand.choice([".", "!?", "###", ""]))
            assert stem == w and whole.encode(head + w + marks, add_special_tokens=False).ids == model(w) + (
                whole.encode(marks, add_special_tokens=False).ids if marks else [])


def test_a_tokenizer_that_does_more_to_letters_is_asked_itself():
    other = Tokenizer.from_file(word_tokenizer_path())
    other.normalizer = None  # no lower case
    assert not lib.Letters(other, lower=True).right


def test_long_texts_are_cut_between_words():
    whole = Tokenizer.from_file(tokenizer_path())
    ids = lambda t: whole.encode(t, add_special_tokens=False).ids
    for text in texts(3, 500, most=200):
        parts = list(lib.long_parts(text, 20))
        assert "".join(parts) == text
        assert [i for p in parts for i in ids(p)] == ids(text)


def test_values_are_learned_once_and_forgotten():
    learned = []

    def learn(keys):
        learned.append(sorted(keys))
        return [k.upper() for k in keys]

    known = lib.Known(learn, most=3)
    assert list(map(known.meet([["a", "b"], ["a"]]), ["a", "b", "a"])) == ["A", "B", "A"]
    assert list(map(known.meet([["b", "c", "d"]]), ["b", "c", "d"])) == ["B", "C", "D"]
    assert sorted(learned[1]) == ["c", "d"]
    known.meet([["a", "e"]])  # a new generation begins: a is taken over, e is new
    assert learned[2] == ["e"] and sorted(known.values) == ["a", "e"] and len(known.older) == 4
    known.meet([["f", "g"]])
    known.meet([["a", "b"]])  # the next one: b is forgotten
    assert learned[-1] == ["b"] and sorted(known.values) == ["a", "b"]
