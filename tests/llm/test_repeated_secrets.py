from siltlake.llm import secrets

KEY = "Zq7vK2mXw9RtB4nLpE8sYc3H"


def found(text):
    return [text[s:e] for s, _, e in secrets.scan(text)[1]]


def test_a_repeated_key_does_not_foretell_itself():
    text = f"the access credential is {KEY} and on retry the bearer sends {KEY} again"
    assert found(text) == [KEY, KEY]
    assert secrets.redact(text) == "the access credential is [SECRET] and on retry the bearer sends [SECRET] again"
    assert found(f"the access credential is {KEY}, " * 4) == [KEY] * 4


def test_every_place_of_a_novel_string_is_reported():
    text = f"the access credential is {KEY} for all. " + "A long way on, nothing speaks of it. " * 12 + f"Here is {KEY} once more"
    assert found(text) == [KEY, KEY]
    assert KEY not in secrets.redact(text)


def test_a_base_span_does_not_hide_a_later_place():
    text = f"api_key={KEY} and then the bearer sends {KEY} again"
    assert found(text) == [KEY] and KEY not in secrets.redact(text)


def test_repeated_words_stay():
    assert found("the access of authentication_backend2 and the access of authentication_backend2") == []
