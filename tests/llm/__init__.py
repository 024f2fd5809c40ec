"""A package, so that its ``test_oracles`` and that of the folder above are two modules; its tests import each other by plain name."""

import os
import sys

sys.path.append(os.path.dirname(os.path.abspath(__file__)))
