"""A fresh local folder for one test."""

import os
import tempfile


def local_scratch_dir(prefix: str = "ledgerlens-") -> str:
    return tempfile.mkdtemp(prefix=prefix, dir=os.environ.get("TMPDIR", "/tmp"))
