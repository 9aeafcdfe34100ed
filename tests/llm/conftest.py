from __future__ import annotations

import pathlib
import sys

# Plain versions are shared between the test modules.
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))
