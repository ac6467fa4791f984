"""``python -m tripline <stage> ...`` — see tripline.cli."""

import sys

from tripline.cli import main

main(sys.argv[1:])
