"""Entry script for spark-submit."""

from voltstream.cli import main

if __name__ == "__main__":
    main()
