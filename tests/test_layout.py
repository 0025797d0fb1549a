"""The test modules themselves: pytest loads them by base name, so no two may share one."""

import collections
import glob
import os


def test_no_two_test_modules_share_a_name():
    here = os.path.dirname(os.path.abspath(__file__))
    names = collections.Counter(os.path.basename(p) for p in glob.glob(f"{here}/**/*.py", recursive=True))
    assert [n for n, times in names.items() if times > 1] == []
