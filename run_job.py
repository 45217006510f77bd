"""Entry point for ``spark-submit``; see ``siltworks.jobs``. Executors need no files: no Python runs there."""

from siltworks.jobs import main

if __name__ == "__main__":
    main()
