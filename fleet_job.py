"""Command line for the phase job: `spark-submit fleet_job.py --root ROOT --input BASE [options]`."""

from motorpool.plans.job import main

if __name__ == "__main__":
    main()
