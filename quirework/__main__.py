"""The command line: ``python -m quirework --input_folder FOLDER ...``."""

import sys

from quirework.plans.run import main

sys.exit(main())
