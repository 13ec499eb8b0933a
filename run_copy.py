"""Entry script for spark-submit: copies a database; see ``--help``."""

from tablewharf.__main__ import main

if __name__ == "__main__":
    raise SystemExit(main())
