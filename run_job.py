"""Entry for ``spark-submit run_job.py <job> ...``; see :mod:`stoploom.jobs`."""

from stoploom.jobs import main

if __name__ == "__main__":
    main()
