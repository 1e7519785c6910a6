"""Secrets glued to names and in paths."""

import random
import string

from quirestone.llm import secret_scan

CUT = secret_scan.bin_of(1e-3, 20)


def test_random_values_behind_a_name_and_in_a_path_are_found():
    r = random.Random(3)
    for _ in range(20):
        value = "".join(r.choice(string.ascii_letters + string.digits) for _ in range(40))
        for before, after in (("AWS_KEY=", " end"), ("export X_Y=", "\n"), ("see my-files/v_1/", " there"), ("a=b=", "== c")):
            text = before + value + after
            found = [(s, e) for s, e, k in secret_scan.all_spans(text, CUT) if k == "random"]
            assert len(found) == 1 and text[slice(*found[0])].rstrip("=").endswith(value)
            assert "/" in before or found[0][0] == len(before)  # in a path a short last folder may go too
            assert value not in secret_scan.redact(text, CUT)
    plain = "the-quick_brown/fox-jumps_over/the-lazy_dog and name_of_thing=another_plain_name_of_things"
    assert secret_scan.all_spans(plain, CUT) == []
