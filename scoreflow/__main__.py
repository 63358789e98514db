"""``python -m scoreflow <job> ...`` runs the job CLI (see ``scoreflow.cli``)."""

import sys

from scoreflow.cli import main

sys.exit(main())
