from tallyline.cli import main

raise SystemExit(main())
