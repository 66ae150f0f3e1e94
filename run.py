"""Entry script for spark-submit; see ``clicklake/cli.py`` for the jobs."""

from clicklake.cli import main

if __name__ == "__main__":
    main()
