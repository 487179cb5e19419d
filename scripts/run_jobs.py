"""Launcher for the batch jobs: spark-submit scripts/run_jobs.py RAW_DIR WAREHOUSE_DIR RUN_DATE"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.jobs import main  # noqa: E402

if __name__ == "__main__":
    main()
