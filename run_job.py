"""Launcher for ``spark-submit``:

    zip -r basketry.zip basketry
    spark-submit --py-files basketry.zip run_job.py pcy <basket lines> <out> --support 3 --buckets 100

Locally, ``python -m basketry.jobs <job> ...`` does the same.
"""

import sys

from basketry.jobs import main

if __name__ == "__main__":
    main(sys.argv[1:])
