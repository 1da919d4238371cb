import sys
from pathlib import Path

# The helpers of this folder and of the one above are plain modules.
sys.path += [str(Path(__file__).parent), str(Path(__file__).parent.parent)]
