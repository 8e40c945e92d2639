"""``python -m talkmill ...`` runs the generation job (see talkmill.plans.job)."""

from talkmill.plans.job import main

if __name__ == "__main__":
    main()
