from cabline.cli import main

main()
