import sys

from corate.cli import main

sys.exit(main())
