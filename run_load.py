"""Entry script of a load: ``spark-submit --py-files <package> run_load.py --input .. --output ..``."""

from trafficlake.plans.run import main

if __name__ == "__main__":
    main()
