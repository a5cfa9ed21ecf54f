"""Launcher for spark-submit: ``spark-submit --py-files hirescope.zip scripts/run_job.py run ...``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hirescope.__main__ import main  # noqa: E402

if __name__ == "__main__":
    main()
