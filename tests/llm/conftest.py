"""Python workers import the package from where the tests do."""

import os
import pathlib

ROOT = str(pathlib.Path(__file__).parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))
